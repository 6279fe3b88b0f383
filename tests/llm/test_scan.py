"""Scanning noise put into clean text: found, undone; clean text is left alone."""

import random
import textwrap

import pytest

from leafmill.llm import scan as S

NOUNS = "timer buffer session message table handle driver record column printer channel pointer module catalog keyboard network document interface certificate appointment".split()
VERBS = "closes opens resets updates restores calibrates schedules transforms registers duplicates".split()


def sentence(rng):
    return f"The {rng.choice(NOUNS)} {rng.choice(VERBS)} every {rng.choice(NOUNS)} before the {rng.choice(NOUNS)} {rng.choice(VERBS)} one {rng.choice(NOUNS)}."


def clean(seed, n=14):
    rng = random.Random(seed)
    return "\n\n".join(" ".join(sentence(rng) for _ in range(4)) for _ in range(n // 4))


@pytest.fixture(scope="module")
def lex():
    from collections import Counter

    counts = Counter()
    for k in range(400):
        counts.update(S.words_in(clean(k)))
    return S.Lexicon(dict(counts), 400)


def wrapped(text, width=60):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


@pytest.mark.parametrize("seed", range(5))
def test_clean_text_is_left_alone(lex, seed):
    text = wrapped(clean(1000 + seed))
    assert not S.examine(text, "Title", lex).noisy
    table = text + "\n\nadapter  187\n1968\ninbox  345\n\nBack to contents\n\n- item one\n- item two\n\nif (n < 3) return 'd';\nBack to contents\n"
    assert not S.examine(table, "Title", lex).noisy


@pytest.mark.parametrize("hyphen", ["-", "­", "¬"])
def test_broken_words(lex, hyphen):
    text = clean(7)
    noisy = text.replace("calibrates", f"cali{hyphen}\nbrates").replace("message", f"mes{hyphen}\nsage")
    found = S.examine(noisy, None, lex)
    assert found.noisy and found.repaired == text.split("\n\n")


def test_misread_characters_splits_merges_and_specks(lex):
    text = clean(8)
    noisy = text.replace("timer", "tirner").replace("session", "5ession").replace("column", "co1umn").replace("table every", "tab le every").replace("handle", "ha|ndle").replace("message", "messa9e")
    for a, b in (("module", "rnodule"), ("driver", "drivcr"), ("printer", "prlnter"), ("document", "docurnent"), ("network", "nefwork")):
        noisy = noisy.replace(a, b)
    found = S.examine(noisy, None, lex)
    assert found.noisy
    got, want = " ".join(found.repaired).split(), text.split()
    assert sum(a == b for a, b in zip(got, want)) >= 0.95 * len(want)


@pytest.mark.parametrize(("right", "wrong"), [("timer", "ti | mer"), ("session", "ses~sion"), ("column", "co1umn"), ("module", "rnodule"), ("printer", "prlnter")])
def test_one_sure_edit_is_enough(lex, right, wrong):
    text = next(t for k in range(2000, 2100) if f" {right} " in (t := clean(k)))
    assert not S.examine(text, None, lex).noisy
    found = S.examine(text.replace(f" {right} ", f" {wrong} ", 1), None, lex)
    assert found.noisy and found.repaired == text.split("\n\n")


def test_a_broken_word_of_two_usual_halves():
    lex = S.Lexicon({"key": 300, "word": 300, "keyword": 200, "the": 900, "is": 900, "here": 800}, 1000)
    found = S.examine("the key-\nword is here", None, lex)
    assert (found.noisy, found.edits.hyphens, found.repaired) == (True, 1, ["the keyword is here"])
    assert not S.examine("the key-\nhere is", None, lex).noisy


@pytest.mark.parametrize(("on", "usual", "misread"), [(1, 8, True), (1, 49, True), (2, 60, True), (3, 60, False)])
def test_the_number_of_pages_is_no_switch(on, usual, misread):
    for pages in (1000, 2000, 2001, 3000):
        assert S.Lexicon({"module": usual, "rnodule": on, "the": pages}, pages).misread("rnodule") is misread, pages


def test_lost_spaces_and_gained_ones_away_from_misread_characters(lex):
    text = clean(8)
    noisy = text.replace("calibrates every", "calibratesevery").replace("before the", "beforethe").replace("keyboard", "key board")
    noisy = noisy.replace("timer", "tirner").replace("session", "5ession").replace("column", "co1umn").replace("message", "messa9e")
    found = S.examine(noisy, None, lex)
    assert found.noisy and " ".join(found.repaired).split() == text.split()
    assert S.decode("theserlal", S.Lexicon({"the": 90, "serial": 40}, 100)).text == "the serial"


@pytest.mark.parametrize("block", ["- {} -\nA GUIDE TO TIMERS", "Page {}\nA Guide to Timers", "A Guide to Timers    {}", "{} | A Guide to Timers", "[{}]\n\f", "{}"])
def test_running_heads(lex, block):
    text = clean(9)
    lines = wrapped(text).split("\n")
    at = next(i for i in range(2, len(lines)) if lines[i - 1] and lines[i] and not lines[i - 1].endswith(".") and lines[i][0].islower())
    noisy = "\n".join([*lines[:at], *block.format(41).split("\n"), *lines[at:]])
    found = S.examine(noisy, "A Guide to Timers", lex)
    assert found.noisy and found.edits.furniture
    assert " ".join(" ".join(found.repaired).split()) == " ".join(text.split())


@pytest.mark.parametrize("speck", [" | ", "~", " ^ ", " '"])
def test_specks_alone(lex, speck):
    text = clean(11)
    noisy = text.replace("timer", f"ti{speck}mer", 1).replace("printer", f"prin{speck}ter", 1)
    assert noisy != text
    found = S.examine(noisy, None, lex)
    assert found.noisy and found.edits.specks and found.repaired == text.split("\n\n")
    between = S.examine(text.replace(" every ", " ~ every ", 1), None, lex)
    assert between.noisy and between.repaired == text.split("\n\n")
    assert not S.examine(text + "\n\nhome | about | contact | help | index\n\n| timer | 3 |\n", None, lex).noisy


@pytest.mark.parametrize(("right", "wrong"), [("column", "(olumn"), ("timer-based", "tirner-based"), ("closes", "close .s"), ("timer", "time ~r"), ("opens", "o~pens")])
def test_misread_beginnings_compounds_and_specks_at_the_ends(right, wrong):
    lex = S.Lexicon({"column": 300, "timer": 300, "based": 200, "the": 900, "closes": 300, "close": 200, "opens": 300, "open": 300, "one": 800, "here": 700}, 1000)
    found = S.examine(f"the one {wrong} here", None, lex)
    assert found.noisy and found.repaired == [f"the one {right} here"]


@pytest.mark.parametrize("text", ["use 'd' here", "the *use* here", "`use` here", 'use "d" here', "a ~use~ here", "the open.close here", "the use.\nOpen here"])
def test_quotes_and_emphasis_are_no_specks(text):
    lex = S.Lexicon({"use": 300, "used": 300, "the": 900, "theuse": 50, "here": 700, "open": 300, "close": 300}, 1000)
    assert not S.examine(text, None, lex).noisy


@pytest.mark.parametrize(
    "pairs",
    [(("calibrates every", "calibratesevery"), ("before the", "beforethe"), ("every keyboard", "everykeyboard")), (("keyboard", "key board"), ("timer", "ti mer"), ("calibrates", "cali brates"), ("message", "mes sage"))],
)
def test_lost_and_gained_spaces_alone(lex, pairs):
    text = next(t for k in range(3000, 3400) if all(a in (t := clean(k)) for a, _ in pairs))
    noisy = text
    for a, b in reversed(pairs):
        noisy = noisy.replace(a, b)
    found = S.examine(noisy, None, lex)
    assert found.noisy and " ".join(found.repaired).split() == text.split()


@pytest.mark.parametrize(("numbers", "noisy"), [(["- 41 -"], True), (["Page 41"], True), (["[41]", "[42]"], True), (["41", "42"], True), (["[41]"], False), (["41"], False), (["41", "57"], False)])
def test_page_numbers_between_whole_sentences(lex, numbers, noisy):
    parts = clean(21).replace("\n\n", " ").split(". ")
    lines = [p.rstrip(".") + "." for p in parts]
    for k, number in enumerate(numbers):
        lines.insert(2 + 4 * k, number)
    found = S.examine("\n".join(lines), "Title", lex)
    assert found.noisy is noisy and found.edits.furniture == len(numbers) * noisy
    table = "\n\n".join([clean(21), "adapter  187\n41\n42\ninbox  345\n43"])
    assert not S.examine(table, "Title", lex).noisy


def test_a_word_broken_across_page_furniture(lex):
    text = "Every timer calibrates the session before the keyboard closes one message."
    noisy = text.replace("calibrates", "cali-\n- 41 -\nA Guide to Timers\nbrates")
    found = S.examine(noisy, "A Guide to Timers", lex)
    assert found.repaired == [text] and (found.edits.hyphens, found.edits.furniture) == (1, 2)


def test_a_head_of_any_length(lex):
    head = "A Guide to Timers, " * 12 + "and more"
    lines = wrapped(clean(9)).split("\n")
    at = next(i for i in range(2, len(lines)) if lines[i - 1] and lines[i] and not lines[i - 1].endswith(".") and lines[i][0].islower())
    found = S.examine("\n".join([*lines[:at], f"{head}    41", *lines[at:]]), head, lex)
    assert found.noisy and " ".join(" ".join(found.repaired).split()) == " ".join(clean(9).split())


def test_long_words_may_hold_more_edits():
    lex = S.Lexicon({"internationalisation": 400, "the": 900}, 1000)
    found = S.examine("the 1nternati0na1isation", None, lex)
    assert found.noisy and found.repaired == ["the internationalisation"]
    wide = "a" * 45
    assert S.examine(f"the {wide[:20]}-\n{wide[20:]} the", None, S.Lexicon({wide: 40, "the": 900}, 1000)).repaired == [f"the {wide} the"]


def test_beginnings_are_looked_up_in_the_sorted_words():
    lex = S.Lexicon({"tim": 1, "timer": 5, "zebra": 2}, 10)
    assert [lex.begins(w) for w in ("t", "tim", "time", "timers", "", "zebra", "zz")] == [True, True, True, False, True, True, False]
    assert [lex.count(w) for w in ("timer", "tim", "ti", "zz")] == [5, 1, 0, 0]
    assert S.lexicon_bound(150) == pytest.approx(225)  # MB, for 150 different words a page


def test_paragraphs_keep_code_and_lists():
    text = "First line of some text that goes on\nand ends here.\n\n    if (a) {\n        b();\n    }\n\n- one\n- two\n\nSecond paragraph stands here and it is\nlong enough to be one."
    got = S.paragraphs(text.split("\n"))
    assert got[0] == "First line of some text that goes on and ends here."
    assert got[-1] == "Second paragraph stands here and it is long enough to be one."
    assert "    if (a) {\n        b();\n    }" in got and "- one\n- two" in got


def test_column(spark):
    rows = [(k, wrapped(clean(k)), "T", 1) for k in range(80)]
    rows += [(100, clean(100).replace("calibrates", "cali-\nbrates"), None, 1), (101, None, None, 1), (102, "", "", 1), (103, "7", None, 1), (103, "7", None, 1), (104, "x" * 100_000, None, 1)]
    df = spark.createDataFrame(rows, "page_id long, body string, title string, text int")
    got = S.scan_noise(df, "page_id", "body", "title").collect()
    assert [r["page_id"] for r in got] == [100]
    assert S.scan_noise(df.where("false"), "page_id", "body", "title").count() == 0
