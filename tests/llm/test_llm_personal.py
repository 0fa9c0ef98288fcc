"""Added kinds of personal data: no bound on passwords, cues in any letters, long texts."""

import time

import pytest

from ledgerlens.llm import personal


def texts(text):
    return {k: [text[a:b] for a, b in v] for k, v in personal.spans(text).items() if v}


@pytest.mark.parametrize("size", [1, 399, 450, 5000])
def test_passwords_of_any_length(size):
    text = f"see ftp://me:{'p' * size}@host.example.org/x and http://no.user.org/a:b"
    assert texts(text)["user"] == [f"me:{'p' * size}"]


@pytest.mark.parametrize("cue", ["customer No", "CUSTOMER NO", "Customer No", "cUsToMeR nO"])
def test_cues_in_any_letters(cue):
    assert texts(f"{cue} 123456, thanks")["account"] == ["123456"]
    assert texts(f"İé {cue} 123456")["account"] == ["123456"]


def test_iban_cue_in_any_letters():
    assert texts("iBaN: DE89 3704 0044 0532 0130 00.")["iban"] == ["DE89 3704 0044 0532 0130 00"]


def test_lowered_keeps_places():
    for text in ("ABC é İX", "Ab1", "", "ẞK"):
        low = personal.lowered(text)
        assert len(low) == len(text)
        # ASCII letters are small; no other character becomes one of them
        assert all(b == a.lower() if a.isascii() else not b.isascii()
                   for a, b in zip(text, low, strict=True))


def test_very_long_texts_in_linear_time():
    """Many anchors, and long runs that come near a match."""
    for piece in ("a://b:c", "x@", "+1 ", "://" + "u" * 50 + ":", "account ", "1.2.3."):
        long = piece * (400_000 // len(piece))
        start = time.perf_counter()
        personal.spans(long)
        assert time.perf_counter() - start < 10, piece
    text = "mail a@b.co " * 50_000 + "ftp://u:" + "p" * 100_000 + "@h.de"
    found = personal.spans(text)
    assert len(found["email"]) == 50_001 and len(found["user"]) == 1
