"""Quality votes and rules: exact statistics, held-out accuracy, odd inputs."""

import collections
import re
import zlib

from kindred.llm import quality_knn, quality_rules
from kindred.session import table

SF = "/root/testdata/sf0.01"


def statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for k in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_statistics_of_odd_texts(spark, docs, odd_texts, none):
    more = [(100, "a b c a b c"), (101, "a a a a"), (102, "a a a"), (103, "x\nx \nx\n\nx"), (104, "a b c d a b"), (105, "#*$%&|<> \x0b é🙂\x85w")]
    extra = spark.createDataFrame([(i, t) for i, t in more], "doc_id long, text string")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for df, texts in ((docs, odd_texts), (extra, more)):
        rows = quality_rules.judged(df, []).select(*columns).collect()
        assert collections.Counter(map(tuple, rows)) == collections.Counter((i, *statistics(t)) for i, t in texts)
    assert quality_rules.judged(none, []).count() == 0


def test_op6_on_held_out_labels_without_python(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = quality_rules.op6(docs, labels)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())
    rows = {r.doc_id: r for r in found.collect()}
    marks = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    judged = [(rows[i].kept, q) for i, q in marks if not rows[i].base_failed]
    assert sum(k == (q == 1) for k, q in judged) >= 0.9 * len(judged)
    assert all(not r.kept for r in rows.values() if r.base_failed)
    assert all(k for k, q in judged if q == 1)


def test_learned_rules_are_readable_and_apply_in_order():
    rows = [{"doc_id": i, "label": int(i % 4 != 0), **dict.fromkeys(quality_rules.FEATURES, 0.1)} for i in range(240)]
    for r in rows:
        if not r["label"]:
            r["symbols_per_word" if r["doc_id"] % 8 else "upper_share"] = 0.9
    rules = quality_rules.learn(rows)
    assert rules and all(any(rule.holds(r) for rule in rules) == (r["label"] == 0) for r in rows)
    assert all(re.fullmatch(r"\w+ [<>]= [\d.e-]+D( AND \w+ [<>]= [\d.e-]+D)*", rule.sql()) for rule in rules)
    assert quality_rules.learn([]) == [] and quality_rules.learn([r for r in rows if r["label"]]) == []


def test_sample_and_weight_are_of_documents_that_can_be_judged(spark, monkeypatch):
    free = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 != 1]
    marks = {i: int(k >= 100) for k, i in enumerate(free[:300])}
    long, bad = " ".join(f"w{k}" for k in range(60)), [i for i, q in marks.items() if not q]
    texts = [(i, long) for i, q in marks.items() if q] + [(i, long) for i in bad[:20]] + [(i, "short") for i in bad[20:60]]  # 40 of label 0 are gone
    seen = []
    monkeypatch.setattr(quality_rules, "learn", lambda rows, weight: seen.append((rows, weight)) or [])
    quality_rules.learn_from(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(list(marks.items()), "doc_id long, quality int"), per_class=50)
    (rows, weight), = seen
    assert collections.Counter(r["label"] for r in rows) == {0: 20, 1: 50}
    assert abs(weight - (200 / 50) / (20 / 20)) < 1e-9


def test_columns_with_the_names_of_statistics_give_way(spark):
    rows = spark.createDataFrame([(1, "a b", 7, "x", 0.5, "y")], "doc_id long, text string, N_words int, _text string, mean_word double, _own string")
    out = quality_rules.judged(rows, [])
    assert [c for c in out.columns if c.lower() == "n_words"] == ["n_words"] and out.first().n_words == 2 and out.first()._text == "x" and out.first()._own == "y"
    assert quality_rules.kept(rows, []).columns == rows.columns
    assert quality_rules.statistics(rows.select("text")).first().n_words == 2


def test_kept_rows_keep_their_columns(spark, docs):
    out = quality_rules.kept(docs, [])
    assert out.columns == docs.columns and out.count() == sum(not statistics(r.text)[-1] for r in docs.collect())


def test_op2_on_held_out_labels(spark):
    labels = table(spark, SF, "labels")
    rows = quality_knn.op2(table(spark, SF, "documents"), labels).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    own = [r for r in rows if r.held_out and r.doc_id in marks]
    assert sum(r.predicted == marks[r.doc_id] for r in own) >= 0.9 * len(own)


def test_op2_over_odd_texts(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(3, None, 1), (None, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality_knn.op2(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0.5 for r in quality_knn.op2(docs, labels.limit(0)).collect())
    assert quality_knn.op2(none, labels).count() == 0
    same = collections.defaultdict(set)
    for r in rows:
        same[r.doc_id].add(r.score)
    assert len(same[9]) == 1


def test_votes_are_exact_cosines(spark):
    import numpy as np

    texts = [f"{'ab' * (i + 3)} {'xyz' * (9 - i)} tail" for i in range(8)]
    counts = quality_knn.term_counts(texts)
    model = quality_knn.Model(counts, np.array([0, 1] * 4, np.float32))
    z = model.project(quality_knn.weighted(counts, model.idf)).astype(float)
    cosines = np.clip(z @ z.T, 0, None) ** 4
    want = (cosines * np.array([0, 1] * 4)).sum(1) / cosines.sum(1)
    assert np.allclose(model.scores(texts), want, atol=1e-4)
