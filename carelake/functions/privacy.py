"""Hashing, redaction and masking expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Redaction patterns and tags, applied in this order.
PII_PATTERNS = (
    ("pix", r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "[PIX_REDACTED]"),
    ("card", r"\b\d{4}[\s\-]?\d{4}[\s\-]?\d{4}[\s\-]?\d{4}\b", "[CARD_REDACTED]"),
    ("phone_intl", r"\+55\s?\(?\d{2}\)?\s?\d{4,5}[\s\-]?\d{4}", "[PHONE_REDACTED]"),
    ("phone_local", r"\(?\d{2}\)?\s?\d{4,5}[\s\-]?\d{4}", "[PHONE_REDACTED]"),
    ("cpf", r"\d{3}\.?\d{3}\.?\d{3}-?\d{2}", "[CPF_REDACTED]"),
    ("rg", r"\d{2}\.?\d{3}\.?\d{3}-?\d{1}", "[RG_REDACTED]"),
    ("email", r"[\w\.\-]+@[\w\.\-]+\.\w+", "[EMAIL_REDACTED]"),
    ("account", r"\b\d{4}[\s\-]?\d{5,6}[\s\-]?\d{1}\b", "[ACCOUNT_REDACTED]"),
)
PII_TAGS = ("PIX", "CARD", "PHONE", "CPF", "RG", "EMAIL", "ACCOUNT")
CPF_FORMATTED = r"\d{3}\.\d{3}\.\d{3}-\d{2}"
CNPJ_FORMATTED = r"\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}"
CPF_MASK = "***.***.***-**"
CNPJ_MASK = "**.***.***/****-**"

# Every digit pattern above needs three digits in a row, the e-mail pattern an
# "@", the PIX pattern a dashed group of four; and no tag holds any of these. A
# text with none of them therefore passes the whole chain unchanged, so one
# scan replaces eight for most texts. The first class rules out most positions
# before an alternative is tried.
_PII_HINT = r"[\d@\-](?:(?<=@)|(?<=\d)\d\d|(?<=-)[0-9a-fA-F]{4}-)"

# What published text must not hold, a formatted CPF or a phone.
LEAK_PATTERN = r"\d{3}\.\d{3}\.\d{3}-\d{2}|\+?\d{10,13}"
# Found in the same texts: ten digits in a row are a phone whatever is beside them. Both begin
# with three digits, so most positions are ruled out by one test.
_LEAK_HINT = r"\d{3}(?:\d{7}|\.\d{3}\.\d{3}-\d{2})"


def scrub_pii(text: Column, unicode: bool = False) -> Column:
    """Replace structured personal data in free text by tags; NULL stays NULL.

    ``unicode`` makes digits, spaces and word characters match beyond ASCII.
    """
    flag = "(?U)" if unicode else ""
    scrubbed = text
    for _, pattern, tag in PII_PATTERNS:
        scrubbed = F.regexp_replace(scrubbed, flag + pattern, tag)
    return F.when(text.rlike(flag + _PII_HINT), scrubbed).otherwise(text)


def redaction_count(scrubbed: Column, tag: str) -> Column:
    """How many times a tag occurs in scrubbed text."""
    return F.regexp_count(scrubbed, F.lit(rf"\[{tag}_REDACTED\]"))


def mask_pii(text: Column) -> Column:
    """Mask formatted CPF and CNPJ numbers; bare digits stay."""
    masked_cpf = F.regexp_replace(text, CPF_FORMATTED, CPF_MASK)
    return F.regexp_replace(masked_cpf, CNPJ_FORMATTED, CNPJ_MASK)


def has_leak(text: Column) -> Column:
    """Whether text still holds a CPF or phone number."""
    return text.rlike(_LEAK_HINT)


def hash_id_salted(identifier: Column, salt: str) -> Column:
    """Hex SHA-256 of the id followed by the salt; NULL id gives NULL."""
    return F.sha2(F.concat(identifier.cast("string"), F.lit(salt)), 256)


def hash_id_unsalted(identifier: Column) -> Column:
    """Hex SHA-256 of the id alone. These keys never join with salted ones."""
    return F.sha2(identifier.cast("string"), 256)


def mask_phone_for_logs(phone: Column) -> Column:
    """Only the last four characters."""
    return F.right(phone, F.lit(4))
