"""Base counts against a plain loop; the adaptive verdict against its SQL twin."""

import random
import re

import duckdb

from churnlens.llm import quality_rules

SF = "/root/testdata/sf0.001"


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_of_edges(make_docs, edge_texts):
    texts = [*edge_texts, "a b c d e f " * 3, "x y\nx y\n\n \nx y", "one two three four five one two three four five",
             "q " * 9, "é🙂 " * 12, "a b c d e", "a b c d e x a b c d e y a b c d e"]
    docs = make_docs([*enumerate(texts), (None, "a a"), (0, None)])
    rows = quality_rules.judged(docs, "doc_id").collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "a a" if r.doc_id is None else texts[r.doc_id]
        assert tuple(r[c] for c in COUNTS) == slow(text), text
        assert not (r.base_failed and r.kept)
    assert quality_rules.judged(make_docs([]), "doc_id").collect() == []


def test_whole_table_equals_its_sql(spark):
    got = quality_rules.op10_adaptive_rules(spark, SF)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(quality_rules.OP10_SQL)
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.select(", ".join(order)).fetchall())


def test_fences_follow_language_and_source(spark):
    plain, loud = "abcd efgh ijkl mnop " * 5, "AB# CD# EF# GH# "
    words = lambda base, i: " ".join(f"{w}{chr(97 + (i * 7 + k) % 26)}{chr(97 + i % 26)}{chr(97 + k)}" for k, w in enumerate(base.split())) + "z" * (i % 9 // 4)
    rows = [(i, words(plain, i), "en", "calm", "x") for i in range(600)]
    rows += [(1000 + i, words(loud * 5, i), "en", "code", "x") for i in range(600)]
    rows += [(2000, words(loud * 5, 1), "en", "calm", "x"), (2001, words(plain, 3), None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, ratios string")
    kept = {r.doc_id for r in quality_rules.keep_passing(docs).collect()}
    assert kept == {r[0] for r in rows} - {2000}
    assert quality_rules.keep_passing(docs).columns == docs.columns


def test_every_rule_rejects_a_text(spark, monkeypatch):
    """One text per rule that is kept as soon as this rule is left out, among texts that vary a little."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    sentence = lambda n=40: [word(rng.randrange(3, 9)) for _ in range(n)]

    def plain():
        w = sentence()
        if rng.random() < 0.3:
            w[3] += "#"
        if rng.random() < 0.5:
            w[5] = w[5].upper()
        if rng.random() < 0.1:  # a window of five words twice in a long text
            w = [*w, *sentence(400), *w[:5]]
        lines = [" ".join(w[i:i + 4]) for i in range(0, len(w), 4)]
        if rng.random() < 0.1:
            lines.append(lines[0])
        return "\n".join(lines)

    rows = [(i, plain()) for i in range(400)]
    twice = sentence(9)
    odd = {"word_length": " ".join(word(30) for _ in range(40)),
           "symbols_per_word": " ".join(w + "#$%" for w in sentence()),
           "upper_per_char": " ".join(sentence()).upper(),
           "dup_line_share": "\n".join("q z\n" + " ".join(sentence(3)) for _ in range(20)),
           "repeat_word_share": " ".join([*twice, *sentence(85), *twice])}
    rows += [(1000 + i, t) for i, t in enumerate(odd.values())]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judged(docs, "doc_id").where("not base_failed").collect()}
    assert sum(not kept[i] for i in range(400)) <= 4
    assert [n for i, n in enumerate(odd) if kept[1000 + i]] == []
    rules = dict(quality_rules.RATIOS)
    for i, name in enumerate(rules):
        others = {n: r for n, r in rules.items() if n != name}
        monkeypatch.setattr(quality_rules, "RATIOS", others)
        monkeypatch.setattr(quality_rules, "FENCES", [f"{side}{k}" for k in range(len(others)) for side in ("lo", "hi")])
        assert quality_rules.judged(docs, "doc_id").where(f"doc_id = {1000 + i}").first().kept, name


def test_small_groups_lean_on_their_parents(spark):
    """Two rows of a source alone would fence everything out; the language's rows speak for them."""
    rows = [(i, " ".join("w" * (3 + (i * k) % 5) + chr(97 + k) for k in range(30)), "en", "big") for i in range(300)]
    rows += [(1000, rows[3][1], "en", "tiny"), (1001, rows[4][1] + " longerword", "en", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r.kept for r in quality_rules.judged(docs, "doc_id").where("doc_id >= 1000").collect())
