"""Entities are found whole: surnames of any form, given names alone, secrets at any border, long addresses."""

import pytest

from truegrain.llm.pii import find, rewrite


def entities(text):
    return [(kind, text[start:end]) for start, end, kind in find(text)]


@pytest.mark.parametrize("name", ["McDonald", "JONES", "Šimková", "O'Brien", "O’Brien", "D'Angelo", "Smith-Jones", "Łukasz-Żak", "Öztürk"])
def test_surnames_are_whole(name):
    assert entities(f"Then Mary {name} left.") == [("given_f", "Mary"), ("surname", name)]
    assert entities(f"Then Mrs {name}'s dog left.") == [("surname", name)]
    new, _ = rewrite(b"k", f"Mary {name} met Peter, and {name} left.", {})
    assert not [part for part in name.replace("’", "'").replace("-", "'").split("'") if len(part) > 1 and part in new]


def test_given_names_are_found_again_alone():
    text = "Mary Jones and Mr Ugo Bossi came. Mary left with Ugo, Maryland did not."
    assert entities(text)[4:] == [("given_f", "Mary"), ("given_m", "Ugo")]
    new, spans = rewrite(b"k", text, {})
    assert spans[0]["surrogate"] == spans[4]["surrogate"] and spans[2]["surrogate"] == spans[5]["surrogate"]


@pytest.mark.parametrize("before", ["", "\n", "\t", "[", "/", "(", "=", ' "', "key:"])
def test_secrets_at_any_border(before):
    assert entities(f"{before}0123456789abcdef01]") == [("secret", "0123456789abcdef01")]
    assert entities(f"{before}x0123456789abcdef01") == []


def test_a_long_local_part_is_whole():
    address = "first.last+" + "x1" * 60 + "@mail.example.com"
    assert entities(f"To {address}, now") == [("email", address)]
