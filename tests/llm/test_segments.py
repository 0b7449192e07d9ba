"""The memory of segments: numbering of keys, and ids equal to encoding whole texts while it forgets."""

import numpy as np
import pyarrow as pa
import public_tokenizers

from carelake.llm.arrays import distinct_parts, word_bounds
from carelake.llm.tokens import MARKS, Numbers, TokenBytes


def test_numbers_follow_the_order_of_arrival():
    rng = np.random.default_rng(5)
    # Few low bits, so that most keys meet others at their place.
    keys = np.unique(rng.integers(0, 1 << 40, 3000).astype(np.uint64) << np.uint64(6))
    rng.shuffle(keys)
    numbers = Numbers(len(keys))
    for part in np.array_split(keys, 7):
        assert (numbers.find(part) == -1).all()
        numbers.add(part)
    assert (numbers.find(keys) == np.arange(len(keys))).all()
    assert (numbers.find(keys | np.uint64(1)) == -1).all()


def test_ids_stay_whole_while_segments_are_forgotten():
    texts = ["".join(f" w{i * j % 997}é" for j in range(400)) for i in range(60)] + ["", None, "a  b \n c", "  "]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder = TokenBytes(public_tokenizers.path(name))
        encoder._forget(50)  # less than one piece holds
        for _ in range(2):
            for text, ids in zip(texts, encoder.encode(pa.array(texts))):
                assert ids == encoder.whole(text or "").tobytes()


class Counting:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **options)


def test_new_words_are_encoded_together():
    """Far fewer texts than words reach the tokenizer; marks, odd white space and combining letters among the words change no id."""
    encoder = TokenBytes(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.mark
    plain = " ".join(f"w{i}x" for i in range(6400))
    odd = [*MARKS, "".join(MARKS), "a^b", f"^{encoder.mark}^", "\u0301x", "e\u0301", "\u00a0", "\u3000y", "don't", "\u0130I", "\u200b", "\x00", "\ufeff", "<|", "|>"]
    texts = [plain, " ".join(odd), *odd, "\n".join(f"{a} v{i} {b}" for i, (a, b) in enumerate(zip(odd, odd[::-1])))]
    expected = [encoder.whole(text).tobytes() for text in texts]
    encoder.tokenizer = Counting(encoder.tokenizer)
    assert list(encoder.encode(pa.array(texts))) == expected
    assert encoder.tokenizer.texts < 100 + 64 * 4


def test_distinct_parts():
    data = np.frombuffer("b a  aé a b\nzz aé".encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, 5, len(data)]))
    words = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    codes, distinct = distinct_parts(data, starts, ends)
    assert [distinct[int(c)].as_py() for c in codes] == words and distinct.to_pylist() == list(dict.fromkeys(words))
    codes, distinct = distinct_parts(np.frombuffer(b"aabb", np.uint8), np.array([0, 1, 2]), np.array([1, 2, 4]))
    assert codes.tolist() == [0, 0, 1] and distinct.to_pylist() == [b"a", b"bb"]
