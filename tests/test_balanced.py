"""Balanced regions against a direct statement of the rule."""

import random
import time

import pytest

from pagequarry.functions import balanced


def expected(text, region):
    """Cut closed regions one after the other, searching from the last cut."""
    at = 0
    while (start := text.find(region.starter, at)) >= 0:
        depth, pos = 1, start + len(region.starter)
        while depth:
            marks = [(p, d, len(m)) for m, d in ((region.opener, 1), (region.closer, -1)) if (p := text.find(m, pos)) >= 0]
            if not marks:
                return text
            where, change, width = min(marks)
            depth, pos = depth + change, where + width
        text, at = text[:start] + text[pos:], start
    return text


PIECES = {
    "template": (balanced.TEMPLATE, ["{{", "}}", "{", "}", "a", "b\n", "{{{", "}}}"]),
    "table": (balanced.TABLE, ["{|", "|}", "{", "|", "}", "a", "||}", "{||"]),
    "image": (balanced.IMAGE, ["[[Bild:", "[[", "]]", "[", "]", "a", "Bild:", "[[["]),
    "math": (balanced.MATH, ["<math>", "</math>", "<", "math>", "a", "</", "\n"]),
    "general": (balanced.Region.of("<<", ">>", "<<x"), ["<<x", "<<", ">>", "<", ">", "x", "a"]),
    "opener begins closer": (balanced.Region.of("<", "</"), ["<", "</", "/", "a", "é\n"]),
    "closer begins opener": (balanced.Region.of("</", "<"), ["<", "</", "/", "a", "//"]),
    "other starter": (balanced.Region.of("[[", "]]", "Bild"), ["Bild", "[[", "]]", "[", "]", "Bi", "ld", "x"]),
    "starter ends in opener": (balanced.Region.of("(", ")", "f("), ["f(", "(", ")", "f", "\U0001f600"]),
    "overlapping": (balanced.Region.of("aa", "ba"), ["aa", "ba", "a", "b", "c"]),
    "same beginning": (balanced.Region.of("aa", "ab"), ["aa", "ab", "a", "b", "c"]),
    "chained": (balanced.Region.of("ab", "bc", "ca"), ["ab", "bc", "ca", "a", "b", "c"]),
}


def test_which_regions_have_fixed_tokens():
    assert [kind for kind, (region, _) in PIECES.items() if region.plain] == ["template", "table", "image", "math", "general", "same beginning"]


def test_any_delimiters_in_linear_time(apply):
    """Nulls, empty texts, many regions, an open one; four times the text, at most five times the time."""
    region = balanced.Region.of("[[", "]]", "Bild:")
    unit = "a Bild:x [[b]] ]] c [[d]] "
    seconds = []
    for times in (10_000, 40_000):
        began = time.monotonic()
        got = apply(lambda t: balanced.remove_regions(t, region), [unit * times, "Bild:" + unit * times, None, ""])
        seconds.append(time.monotonic() - began)
        assert got == [expected(unit * times, region), expected("Bild:" + unit * times, region), None, ""]
    assert seconds[1] <= 5 * max(seconds[0], 1.0), seconds


@pytest.mark.parametrize("kind", PIECES)
@pytest.mark.parametrize("nesting", [2, balanced.NESTING])
def test_random_texts(apply, kind, nesting):
    region, pieces = PIECES[kind]
    rng = random.Random(f"{kind}{nesting}")
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 18))) for _ in range(3000)]
    texts += [region.starter * 14 + "x" + region.closer * 14 + "y", region.starter * 14 + region.closer * 13]
    found = apply(lambda t: balanced.remove_regions(t, region, nesting), texts)
    wrong = [(t, f, expected(t, region)) for t, f in zip(texts, found) if f != expected(t, region)]
    assert not wrong, wrong[:3]


def test_whole_fold_agrees(apply):
    region, pieces = PIECES["template"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 18))) for _ in range(1000)]
    assert apply(lambda t: balanced.fold_regions(t, region, 2), texts) == [expected(t, region) for t in texts]


def test_long_texts(apply):
    """No stack overflow, no quadratic time: closed, unclosed, deep."""
    many = "text {{a|{{b}}|c}} " * 50_000
    texts = [many, "{{open " + many, "{{a " * 20_000, "}}" * 50_000]
    assert apply(lambda t: balanced.remove_regions(t, balanced.TEMPLATE), texts) == [
        "text  " * 50_000, texts[1], texts[2], texts[3],
    ]


@pytest.mark.parametrize("depth", [14, 200])
def test_deep_regions_in_linear_time(apply, depth):
    """Two megabytes nested beyond the pattern: four times the text, at most five times the time."""
    deep = "{{a " * depth + "x" + " b}}" * depth
    seconds = []
    for size in (500_000, 2_000_000):
        unit = "text " + deep + " {{c|{{d}}}} "
        times = size // len(unit)
        began = time.monotonic()
        assert apply(lambda t: balanced.remove_regions(t, balanced.TEMPLATE), [unit * times]) == ["text   " * times]
        seconds.append(time.monotonic() - began)
    assert seconds[1] <= 5 * max(seconds[0], 1.0), seconds
    # One region as deep as the text is long, closed.
    many = 40_000
    whole = "a" + "{{b " * many + "}}" * many + "c"
    assert apply(lambda t: balanced.remove_regions(t, balanced.TEMPLATE), [whole]) == ["ac"]


@pytest.mark.parametrize("opener,closer,starter", [("|", "|", None), ("", "x", None), ("<", "", None)])
def test_bad_delimiters(opener, closer, starter):
    with pytest.raises(ValueError):
        balanced.Region.of(opener, closer, starter)
