"""Disguises of any length and spacing, spelled addresses in four languages, and time that stays linear."""

import time

import pytest

from siltwave.llm import pii


@pytest.mark.parametrize("text, found", [
    ("a" * 250 + " at example dot com", [("email", 0, 269)]), ("write: " + "b" * 380 + " dot c at example dot com", [("email", 7, 412)]),
    ("jo dot doe" + " " * 10 + "at" + "\t" * 12 + "example" + " " * 20 + "dot   com now", [("email", 0, 70)]), ("jo [" + " " * 30 + "at ] example (dot) com", [("email", 0, 56)]),
    ("mail" + " " * 60 + "jane at example.com", [("email", 64, 83)]), ("+1 five" + " " * 9 + "five 5 1 two three 4 5 6 7", [("phone", 0, 42)]),
    ("eins neun zwei punkt eins sechs acht punkt eins punkt eins", [("ip", 0, 58)]), ("uno nueve dos punto uno seis ocho punto uno punto uno", [("ip", 0, 53)]),
    ("un neuf deux point un six huit point un point un", [("ip", 0, 48)]), ("one hundred and ninety-two dot one six eight dot zero dot twenty-one", [("ip", 0, 68)]),
    ("jane @ example . com", [("email", 0, 20)]), ("jane@ mail . example.org!", [("email", 0, 24)]), ("see you @ home . It was", []), ("look at example.com", []), ("two dot five at most", []), ("3 @ 5 . 20 each", []),
])
def test_no_disguise_is_too_long(text, found):
    assert pii.hinted([text])[0] or not found
    assert pii.all_spans(text)[1] == found


@pytest.mark.parametrize("piece", ["a dot ", "a at ", " ", "x" + " " * 3000, "one ", "@ ", "a@", "a . ", "a @ b . ", "five   -   ", "[ ", "( at ", "zwei punkt ", "a.a ", "one  ", "1 five", "plus ", ". five "])
def test_long_runs_take_linear_time(piece):
    text = (piece * (400_000 // len(piece))) + " at"
    began = time.process_time()
    pii.all_spans(text, True)
    assert time.process_time() - began < 4


def test_names_and_gaps_are_found_backwards():
    text = "x jo dot van  dot doe at"
    assert text[pii.left_of(text, 21, 0, "dot") : 21] == "jo dot van  dot doe" and pii.left_of(text, 21, 5, "dot") == 9 and pii.left_of(text, 2, 0, "dot") == 2
    for before, at in (("5 -  ", 1), ("5.", 1), ("5 (", 1), ("5) ", 1), ("5", 1), ("x", 1), ("", 0)):
        assert pii.gap_before(before + "five", len(before)) == at
