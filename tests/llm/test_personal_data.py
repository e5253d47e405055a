"""Base patterns against plain regular expressions; contexts that find unseen identifiers."""

import random
import re

from stridelake.llm import personal_data as pd_


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_equals_plain_patterns():
    rng = random.Random(3)
    parts = ["a@b.c", "x.y+1@mail-1.example.org", "@", "@@b.c", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4539 1488 0343 6467", "4539148803436467", "1234567890123456", "+1 (487) 555-7209", "+4", " ", "é", "word", ".", "-", "0001.2.3.4", "a@b", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert pd_.base_entities(text) == brute(text), text


def test_long_runs_take_linear_time():
    assert pd_.base_entities("7" * 200_000 + " " + "a" * 200_000 + "@") == []


def test_context_finds_unseen_identifiers(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f'some words here token = "{rng.randbytes(20).hex()}" and more', "en") for i in range(40)]
    rows += [(100, 'see token = "Zq81-unseen-77x" here', "en"), (101, "plain a1b2c3d4 text", "en"), (102, None, "en"), (103, "", "en"), (104, "mail a.b@c.de " + "w " * 50_000, "en")]
    rows += [(105, rows[0][1], "en")]
    spark.createDataFrame(rows, "doc_id long, text string, base string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in pd_.op7_personal_data(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert got[100]["spans"] == "found:13:28" and got[100]["n_email"] == 0
    assert got[101]["spans"] == "" == got[102]["spans"] == got[103]["spans"]
    assert got[104]["spans"] == "email:5:13" and got[104]["n_email"] == 1
    assert all("found" in got[i]["spans"] for i in range(40)) and got[105]["spans"] == got[0]["spans"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string")
    red = {r["doc_id"]: r["text"] for r in pd_.redact(docs, pd_.find(docs)).collect()}
    assert red[100] == 'see token = "[FOUND]" here' and red[102] is None and red[104].startswith("mail [EMAIL] w")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pd_.find(docs).count() == 0


def test_null_and_repeated_ids_are_masked(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    rows = [(i, f'some words here token = "{rng.randbytes(20).hex()}" and more', 1) for i in range(30)]
    odd = [(None, "mail a.b@c.de now", "mail [EMAIL] now"), (None, 'a null token = "Zq81-unseen-77x" here', 'a null token = "[FOUND]" here'), (7, "call +1 (487) 555-7209 now", "call [PHONE] now"), (7, "x.y@z.org wrote", "[EMAIL] wrote"), (7, "x.y@z.org wrote", "[EMAIL] wrote"), (None, None, None)]
    docs = spark.createDataFrame(rows + [(d, t, 1) for d, t, _ in odd], "doc_id long, text string, n_chars long").repartition(3)
    key = lambda r: (str(r[0]), str(r[1]))
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.private_spans(spark, docs, "").collect()), key=key)
    wanted = [(i, 'some words here token = "[FOUND]" and more') for i, _, _ in rows] + [(d, m) for d, _, m in odd]
    assert got == sorted(wanted, key=key)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    told = [(r["doc_id"], r["spans"]) for r in pd_.op7_personal_data(spark, str(tmp_path)).collect()]
    wanted = [(i, "found:25:65") for i, _, _ in rows] + [(None, "email:5:13"), (None, "found:16:31"), (7, "phone:5:22"), (7, "email:0:9"), (7, "email:0:9"), (None, "")]
    assert sorted(told, key=key) == sorted(wanted, key=key)


def test_names_of_helpers_pass_and_long_texts_are_whole(spark):
    text = "plain words " * 60_000 + "mail me@example.org now"
    df = spark.createDataFrame([(1, text, 7, "k", "s"), (2, None, 8, "k", "s")], "doc_id long, text string, _row int, _key string, _spans string")
    got = {r["doc_id"]: r for r in pd_.redacted(df).collect()}
    assert got[1]["text"] == text.replace("me@example.org", "[EMAIL]") and got[2]["text"] is None
    assert [(r["_row"], r["_key"], r["_spans"]) for r in (got[1], got[2])] == [(7, "k", "s"), (8, "k", "s")]
