"""Counts and verdicts against a plain loop, on odd texts, repeated rows and clashing columns."""

import random
import re

import pytest

from stridelake.llm import quality_rules as qr

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
SYMBOL = re.compile("[#*$%&|<>]")


def line_fails(line, alone):
    words = WORD.findall(line)
    if not words:
        return False
    if len(SYMBOL.findall(line)) * 20 > len(line) or 2 * line.count("!!") * 10 > len(line):
        return True
    bare = len(words) <= 3 and all(c.isalnum() for c in words[-1]) and len(line) < 60 and not alone
    return bare or any(p in line.lower() for p in qr.BOILERPLATE)


def plain(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    worded = [x for x in lines if WORD.search(x)]
    good = [x for x in lines if not line_fails(x, len(lines) == 1)]
    clean = "\n".join(good)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    lost = len(text) - len(clean)
    kept = not failed and lost * 100 <= len(text) * 50
    return len(words), sum(map(len, words)), len(SYMBOL.findall(text)), len(worded) - len(set(worded)), len(repeated), failed, kept, len(lines) - len(good), lost, clean


def texts():
    rng = random.Random(12)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gämma", "漢字", "x1", "don't", "end."]) for _ in range(n))
    lines = ["Home", "About us now", "Privacy Policy applies", "## $$ %%", "wow!!!! so!!", "", " \t", "Read. More.", " nb sp", "a\x0bb\x0cc\rd"]
    out = [None, "", " ", "\n\n", "one", "a b c a b c", "x " * 120, prose(60), "\n".join([prose(30), *lines, prose(30)]), "Home\n" * 80, "<>" * 40]
    out += ["\n".join(rng.choice([prose(rng.randint(1, 40)), rng.choice(lines)]) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    # Exactly half of the characters lost, and one more.
    body = " ".join(f"w{i}" for i in range(60)) + "."
    out += [body + "\n" + "All rights reserved ".ljust(len(body) - 1, "x"), body + "\n" + "All rights reserved ".ljust(len(body) + 1, "x")]
    return out


def test_counts_and_verdicts_equal_a_loop(spark):
    own = texts()
    rows = [(i, t, True, "s") for i, t in enumerate(own)] + [(5, own[5], True, "s"), (None, own[8], True, "s"), (None, None, True, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEPT boolean, source string")
    got = qr.clean_lines(docs)
    assert got.columns[:3] == ["doc_id", "text", "source"] and got.columns.count("kept") == 1
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "n_chars_removed", "clean_text"]
    found = [(r["doc_id"], r["text"], tuple(r[n] for n in names)) for r in got.collect()]
    assert len(found) == len(rows)
    for _, text, values in found:
        assert values == plain(text), text
    assert sorted((d is None, d or 0) for d, _, _ in found) == sorted((r[0] is None, r[0] or 0) for r in rows)


@pytest.mark.parametrize("unit", ["word ", "a lovely day it was.\n", "Menu\n"])
def test_long_texts(spark, unit):
    text = unit * (1_000_000 // len(unit))
    row = qr.clean_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    n = len(WORD.findall(text))
    assert row["n_words"] == n and row["n_repeat_words"] == n and row["base_failed"] and not row["kept"]
    assert row["clean_text"] == "\n".join(x for x in text.split("\n") if not line_fails(x, "\n" not in text))


def test_empty_table(spark):
    assert qr.clean_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_names_of_helpers_pass(spark):
    names = ["_t", "_w", "_l", "_s", "_p", "_good", "row", "x"]
    df = spark.createDataFrame([(1, "some words here\nand more of them #", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = qr.clean_lines(df).first()
    assert [out[n] for n in names] == names and out["n_words"] == 8 and list(out.asDict())[:10] == ["doc_id", "text", *names]
