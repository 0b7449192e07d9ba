"""Literal cases of the expressions."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from carelake.functions import numeric, privacy, text


def test_salted_hash(values):
    def hashed(salt):
        return values(["abc123", "patient-1", "patient-2", None], lambda c: privacy.hash_id_salted(c, salt))

    first = hashed("my-salt")
    assert first == hashed("my-salt")
    assert first[0] == hashlib.sha256(b"abc123my-salt").hexdigest()
    assert first[0] != hashed("other-salt")[0]
    assert first[1] != first[2]
    assert first[3] is None
    assert all(re.fullmatch("[0-9a-f]{64}", h) for h in first[:3])


def test_unsalted_hash_is_another_family(values):
    plain = values(["abc123"], privacy.hash_id_unsalted)
    assert plain == [hashlib.sha256(b"abc123").hexdigest()]
    assert plain != values(["abc123"], lambda c: privacy.hash_id_salted(c, "s"))


SCRUB_CASES = {
    "CPF 123.456.789-00": "CPF [CPF_REDACTED]",
    "CPF 12345678900": "CPF [PHONE_REDACTED]",
    "4111 1111 1111 1111": "[CARD_REDACTED]",
    "4111111111111111": "[CARD_REDACTED]",
    "+5581999998888": "[PHONE_REDACTED]",
    "5581999998888": "[PHONE_REDACTED]88",
    "(81) 99999-8888": "[PHONE_REDACTED]",
    "81 99999 8888": "[PHONE_REDACTED]",
    "81999998888": "[PHONE_REDACTED]",
    "123e4567-e89b-12d3-a456-426614174000": "[PIX_REDACTED]",
    "ABCDEFAB-ABCD-ABCD-ABCD-ABCDEFABCDEF": "[PIX_REDACTED]",
    "RG 12.345.678-9": "RG [RG_REDACTED]",
    "acct 1234 56789-0": "acct [ACCOUNT_REDACTED]",
    "id 1234567890": "id [PHONE_REDACTED]",
    "CNPJ 12.345.678/0001-90": "CNPJ 12.345.678/0001-90",
    "2024-01-15 10:30": "2024-01-15 10:30",
    "joão@gmail.com": "joã[EMAIL_REDACTED]",
    "Card 4111-1111-1111-1111 informed": "Card [CARD_REDACTED] informed",
    "Email: joao@gmail.com for confirmation": "Email: [EMAIL_REDACTED] for confirmation",
    "Patient needs implant on tooth 36. Budget R$ 5000.": "Patient needs implant on tooth 36. Budget R$ 5000.",
    "CPF 123.456.789-00, phone +5581999998888, email test@test.com":
        "CPF [CPF_REDACTED], phone [PHONE_REDACTED], email [EMAIL_REDACTED]",
    "": "",
    None: None,
}


def test_scrub_cases(values):
    assert values(list(SCRUB_CASES), privacy.scrub_pii) == list(SCRUB_CASES.values())


def test_scrub_unicode_mode(values):
    scrub = lambda c: privacy.scrub_pii(c, unicode=True)
    assert values(["joão@gmail.com", "٨١٩٩٩٩٩٨٨٨٨"], scrub) == ["[EMAIL_REDACTED]", "[PHONE_REDACTED]"]


PIECES = st.lists(
    st.sampled_from(["12", "345", "6789", "-", ".", " ", "(", ")", "+55", "@", "ab", "a.b", "abcdef12", "\n", "é"]),
    max_size=14,
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PIECES.map("".join), min_size=150, max_size=150))
def test_scrub_equals_the_plain_chain(values, texts):
    """The one-scan guard never changes the result of the eight replacements."""

    def chain(column):
        for _, pattern, tag in privacy.PII_PATTERNS:
            column = F.regexp_replace(column, pattern, tag)
        return column

    assert values(texts, privacy.scrub_pii) == values(texts, chain)


def test_record_mask(values):
    inputs = ["123.456.789-00", "12.345.678/0001-90", "12345678900", None]
    assert values(inputs, privacy.mask_pii) == ["***.***.***-**", "**.***.***/****-**", "12345678900", None]


@pytest.mark.parametrize("raw", ["Finalizado", "FINALIZADO", "  finalizado  "])
def test_status_normalisation(values, raw):
    assert values([raw], lambda c: F.lower(F.trim(c))) == ["finalizado"]


def test_summary_quality(values):
    inputs = [None, "   ", "short", "A" * 51, "A" * 49, "A" * 50, "\n"]
    expected = ["missing", "empty", "too_short", "ok", "too_short", "ok", "too_short"]
    assert values(inputs, text.summary_quality) == expected


def test_blank_texts(values):
    assert values(["", " \t\n", " ", " x ", None], text.blank_to_null) == [None, None, None, " x ", None]


def test_phones(values):
    assert values(["+55 81 99999-8888", "", None], text.clean_phone) == ["558199999-8888", "", None]
    assert values(["+5581999998888"], privacy.mask_phone_for_logs) == ["8888"]


def test_names(values):
    names = ["Ana Maria Silva", "Ana", "Not identified", "", None, "Ana "]
    assert values(names, text.first_name) == ["Ana", "Ana", None, None, None, "Ana"]
    assert values(names, text.last_name) == ["Maria Silva", None, None, None, None, ""]


def test_money(values):
    amounts = [1234567.5, 0.0, 3000.0, 0.125, -0.0, 2.675]
    shown = values(amounts, text.money_display, "double")
    assert shown[0] == "\U0001f680 Potential: R$ 1.234.567,50"
    assert [s.rsplit(" ", 1)[1] for s in shown] == [
        f"{v:,.2f}".replace(",", "X").replace(".", ",").replace("X", ".") for v in amounts
    ]
    assert values(amounts, text.money_plain, "double") == [f"{v:.2f}" for v in amounts]


def test_relevance_line_rounds_half_to_even(values):
    lines = values([0.85, 0.125, 0.135, -0.2], lambda c: text.relevance_line(c, F.lit("t")), "double")
    assert lines == [f"  - [{round(s * 100)}% relevant] t" for s in (0.85, 0.125, 0.135, -0.2)]


def test_emoji(values):
    assert values(["Olá 🦷✨ tudo ❤️ bem 📅!"], text.strip_emoji) == ["Olá  tudo  bem !"]


def test_rounding(spark):
    row = spark.range(1).select(
        numeric.rounded_mean(F.lit(10).cast("decimal(10,2)"), F.lit(4), 1).alias("mean"),
        numeric.rounded_mean(F.lit(None).cast("decimal(10,2)"), F.lit(0), 2).alias("none"),
        numeric.rounded_pct(F.lit(1), F.lit(0), 1).alias("zero"),
        numeric.round_half_away(F.lit(-2.5), 0).alias("away"),
    ).first()
    assert (row["mean"], row["none"], row["zero"], row["away"]) == (2.5, None, None, -3.0)
