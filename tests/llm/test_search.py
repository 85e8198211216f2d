"""Jaccard join, top-k search, WARC and URL filter against brute force; the pipeline."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from kindred.llm import ngram_join, pivot_topk, quality_knn, quality_rules, queries, url_filter, warc
from kindred.session import scratch, table

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(texts):
    sets = [(i, shingles(t)) for i, t in texts]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return collections.Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def test_op8_over_odd_texts(docs, odd_texts, none):
    assert collections.Counter(map(tuple, ngram_join.jaccard_components(docs).collect())) == brute_components(odd_texts)
    assert ngram_join.jaccard_components(none).count() == 0


def test_op8_with_groups_chains_and_shared_passages(spark, words):
    rng = random.Random(8)
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(4):  # groups of copies with more and more changes, so that chains of links come up
        own = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        for _ in range(12):
            texts.append(" ".join(own))
            own = list(own)
            own[rng.randrange(len(own))] = rng.choice(words)
    texts += [" ".join(passage + [rng.choice(words) for _ in range(rng.randint(0, 40))]) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert collections.Counter(map(tuple, found.collect())) == brute_components(rows)


def test_op8_exactly_at_the_threshold(spark):
    a = [f"w{i}" for i in range(94)]  # 90 shingles
    rows = [(1, " ".join(a)), (2, " ".join([*a[:76], *(f"x{i}" for i in range(2))]))]
    sets = [shingles(t) for _, t in rows]
    assert 100 * len(sets[0] & sets[1]) <= 80 * len(sets[0] | sets[1])
    for n in range(74, 84):
        rows[1] = (2, " ".join(a[:n]))
        found = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert collections.Counter(map(tuple, found)) == brute_components(rows)


def test_one_of_each_keeps_columns_and_one_row(docs, odd_texts):
    out = ngram_join.one_of_each(docs)
    want = {c for (i, _, c) in brute_components(odd_texts)}
    assert out.columns == docs.columns and collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(want)


def brute_top(vectors, k=20):
    good = [(i, [int(np.floor(64 * float(c))) for c in v]) for i, v in vectors if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = set()
    for q, x in dict(good).items():
        if q % 20 == 0:
            best = sorted({(-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q})[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


VECTORS = "vec_id long, embedding array<float>, label int, pivot string, x string"


def test_op4_over_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6)]) for i in range(300)]
    rows += [(i, rows[40][1]) for i in range(300, 345)]  # ties, queries among them
    rows += [(345, None), (360, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (361, [float("nan")] * 6), (362, [float("inf")] + [0.0] * 5), (363, [0.0] * 6), (364, []), (365, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0, "p", "q") for i, v in rows], VECTORS).repartition(3)
    assert set(map(tuple, pivot_topk.op4(df).collect())) == brute_top(rows)
    few = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.1, 0.2])]
    assert set(map(tuple, pivot_topk.op4(spark.createDataFrame([(i, v, 0, "p", "q") for i, v in few], VECTORS)).collect())) == brute_top(few)
    assert pivot_topk.op4(df.limit(0)).count() == 0


def test_op4_in_small_blocks_and_batches(spark, monkeypatch):
    for name, value in (("BLOCK", 7), ("BATCH", 3), ("SAMPLE", 40), ("PIVOTS", 4)):
        monkeypatch.setattr(pivot_topk, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) + 4 * (i % 3)]) for i in range(200)]
    df = spark.createDataFrame([(i, v, 0, "p", "q") for i, v in rows], VECTORS)
    assert set(map(tuple, pivot_topk.op4(df).collect())) == brute_top(rows)


def test_op4_with_large_components(spark):
    """Products beyond 2**53 and beyond longs: ranks are those of the true scores, a score is the nearest long."""
    rng = np.random.default_rng(9)
    scales = [1.0, 1e5, 3e7, 4e7, 1e9, 1e20, 3e38]
    rows = [(i, [float(np.float32(c * scales[i % 7])) for c in rng.normal(size=3)]) for i in range(90)] + [(100, [4e7, 0.0]), (120, [3e38, -3e38, 1.0]), (121, [3e38, -3e38, 1.0])]
    for chosen in (rows, [r for r in rows if r[0] % 7 < 4], [r for r in rows if r[0] % 7 > 4]):
        df = spark.createDataFrame([(i, v, 0, "p", "q") for i, v in chosen], VECTORS).repartition(2)
        want = {(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in brute_top(chosen)}
        assert set(map(tuple, pivot_topk.op4(df).collect())) == want


def test_op4_reads_the_annuli_of_near_vectors_only(spark, monkeypatch):
    """In groups of near vectors most of the index is left unread, and answers are exact all the same."""
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(40, 16)) * 10
    rows = [(i, [float(np.float32(c)) for c in centres[i % 40] + rng.normal(size=16) * 0.05]) for i in range(4000)]
    df = spark.createDataFrame([(i, v, 0, "p", "q") for i, v in rows], VECTORS).repartition(3)
    monkeypatch.setattr(pivot_topk, "BATCH", 10)
    shares, whole = [], pivot_topk.annuli

    def watched(*args):
        condition, rings = whole(*args)
        index = next(f for f in watching)
        shares.append(index.where(condition).count() / index.count())
        return condition, rings

    build, watching = pivot_topk.build, []
    monkeypatch.setattr(pivot_topk, "build", lambda *a: watching.append((made := build(*a))[0]) or made)
    monkeypatch.setattr(pivot_topk, "annuli", watched)
    assert set(map(tuple, pivot_topk.op4(df).collect())) == brute_top(rows)
    assert len(shares) > 10 and np.mean(shares) < 0.5


def test_op4_counts_repeated_ids_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(120)]
    rows += [(503, [3.0, 3.0, 3.0, 3.0])] * 40 + [(505, [-3.0, 3.0, -3.0, 3.0])] * 3
    rows += [(7, [float(np.float32(c)) for c in rng.normal(size=4)]) for _ in range(30)]  # one id, several vectors
    df = spark.createDataFrame([(i, v, 0, "p", "q") for i, v in rows], VECTORS).repartition(3)
    ints = [(i, [int(np.floor(64 * c)) for c in v]) for i, v in rows]
    want = set()
    for q, x in ints[:120:20]:
        best = {}
        for i, y in ints:
            if i != q:
                best[i] = max(best.get(i, -(2**60)), sum(a * b for a, b in zip(x, y)))
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:20], 1)}
    for block in (1024, 7):
        monkeypatch.setattr(pivot_topk, "BLOCK", block)
        found = list(map(tuple, pivot_topk.op4(df).collect()))
        assert len(found) == 20 * 6 and set(found) == want


PAGES = "page_id long, url string, html string, digest string, `LENGTH` int, block string"


def brute_pages(rows):
    newest = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 1000 and i is not None:
            newest[raw] = max(i, newest.get(raw, i))
    out = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        first = newest.get(raw, i) if i is not None else i
        out[i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first == i else "revisit", None if first == i else first] += 1
    return out


def test_op1_over_odd_pages(spark):
    mark = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    big = "".join(random.Random(1).choice("abc<>\r\n é") for _ in range(400_000))
    rows = [(1, "http://a", None), (2, None, ""), (3, "http://b\r\nX: y", "x" * 999), (4, "", "x" * 999), (5, "u", "y" * 1000), (6, "u", "y" * 1000), (9, "u", "y" * 1000), (7, "u", mark * 40), (8, "u", mark * 40), (10, "u", big + mark + big), (11, "u", "\r\n" * 40_000 + mark), (None, "u", "y" * 1000), (12, "u", "WARC/1.1\r\n" * 70_000), (13, "u", "z" * (warc.CHUNK - 12) + mark)]
    df = spark.createDataFrame([(i, u, h, "d", 1, "b") for i, u, h in rows], PAGES).repartition(3)
    found = warc.op1(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert collections.Counter(map(tuple, found)) == brute_pages(rows)
    assert warc.op1(df.limit(0)).count() == 0


def test_op1_keeps_repeated_and_unnamed_pages_of_several_segments(spark):
    a, b = "a" * (warc.SEGMENT + 9), "b" * (2 * warc.SEGMENT + 9)
    rows = [(1, "u", a), (1, "u", a), (None, "u", a), (None, "u", a), (None, "u", b), (2, "u", b), (2, "u", "c" * 2000), (0, "u", b), (0, "u", b), (3, "u", "d"), (3, "u", "d")]
    df = spark.createDataFrame([(i, u, h, "d", 1, "b") for i, u, h in rows], PAGES).repartition(3)
    found = warc.op1(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert collections.Counter(map(tuple, found)) == brute_pages(rows)
    path = scratch(spark, "warc")
    warc.write(df, path)
    names = [r.record_id for r in warc.read(spark, path).collect()]
    assert len(names) == len(rows) == len(set(names))
    targets = [r.refers_to for r in warc.read(spark, path).collect() if r.refers_to]
    assert len(targets) == 2 and set(targets) <= set(names)


def test_records_that_the_reader_left_together_are_told_apart():
    made = [r for k in range(3) for r in warc.response_records(f"urn:page:{k}:x", "u", b"hello" * k, "d")]
    line = b"\r\n\r\n".join(made).removeprefix(b"WARC/1.1\r\n")
    for end in (b"", b"\r\n\r\n"):
        assert [r[0] for r in warc.parsed([("file", line + end)])] == ["urn:page:0:x", "urn:page:1:x", "urn:page:2:x"]


_END, _MARK = b"\r\n\r\n", b"WARC/1.1\r\n"
_BITS = st.lists(st.sampled_from([_MARK, _END, b"WARC/1.1", b"\r\n", b"\r", b"W", b"Content-Length: 3\r\n", b"x" * 7]), max_size=12).map(b"".join)


@given(st.lists(_BITS, min_size=1, max_size=4), st.integers(1, 60), st.integers(9, 90))
@settings(max_examples=300, deadline=None)
def test_pieces_of_a_file_are_put_together_by_length(payloads, chunk, segment):
    """Own records never hold the separator; others' records may, and come back too."""
    old, warc.CHUNK, warc.SEGMENT = (warc.CHUNK, warc.SEGMENT), chunk, segment
    try:
        own = [r for i, x in enumerate(payloads) for r in warc.response_records(f"urn:page:{i}:x", "u", x, "d")]
        others = [warc.record([("WARC-Record-ID", f"<{i}>")], x) for i, x in enumerate(payloads)]
        for made in (own, others):
            lines = (_END.join(made) + _END).split(_END + _MARK)
            assert made is others or len(lines) == len(made)
            found = list(warc.parsed([("a", x) for x in lines] + [("b", x) for x in lines]))
            assert len(found) == 2 * len(made) and [r[-1] for r in found[: len(made)]] == [r.partition(_END)[2] for r in made]
        if lines:
            with pytest.raises(ValueError, match="cut short"):
                list(warc.parsed([("a", warc.record([], b"x" * 9)[:-1])]))
    finally:
        warc.CHUNK, warc.SEGMENT = old


def test_marks_at_every_place_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 200)
    monkeypatch.setattr(warc, "CHUNK", 50)
    rows = [(i, "u", "x" * i + "\r\n\r\nWARC/1.1" + tail) for i in range(0, 260, 3) for tail in ("", "\r\n", "\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame([(i, u, h, "d", 1, "b") for i, u, h in rows], PAGES).coalesce(2)
    found = warc.op1(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert collections.Counter(map(tuple, found)) == brute_pages(rows)


def test_segments_come_back_in_any_order_and_gaps_are_errors(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 1 << 18)
    payload = random.Random(2).randbytes(700_000)
    parts = [warc.parse(r.removeprefix(b"WARC/1.1\r\n")) for r in warc.response_records("urn:page:1", "u", payload, "d")]
    assert len(parts) == 3
    rows = spark.createDataFrame(parts[::-1], warc.RECORD_SCHEMA).repartition(3)
    assert bytes(warc.payloads(warc.reassembled(rows)).first().payload) == payload
    with pytest.raises(Exception, match="segments are missing"):
        warc.reassembled(spark.createDataFrame(parts[:1] + parts[2:], warc.RECORD_SCHEMA)).collect()
    with pytest.raises(ValueError, match="cut short"):
        warc.parse(b"Content-Length: 10\r\n\r\nabc")


@given(st.binary(max_size=300), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_chunked_framing_is_undone_and_hides_marks(payload, size):
    old, warc.CHUNK = warc.CHUNK, size
    try:
        for body in (payload, payload[:50] + b"WARC/1.1\r\n" * 3 + payload[50:]):
            framed = warc.chunked(body)
            assert warc.dechunked(framed) == body and b"WARC/1.1\r\n" not in framed
    finally:
        warc.CHUNK = old


def test_warc_files_are_read_by_their_own_lengths(spark):
    import gzip
    import pathlib

    path = scratch(spark, "warc").removeprefix("file:")
    warc.write(spark.createDataFrame([(1, "http://a", "hello"), (2, "http://b", "x" * 2000)], "page_id long, url string, html string").coalesce(1), path)
    files = list(pathlib.Path(path).glob("part-*.gz"))
    raw, n = b"".join(gzip.decompress(f.read_bytes()) for f in files), 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[length : length + 4] == b"\r\n\r\n"
        raw, n = rest[length + 4 :], n + 1
    assert n == 2


def test_op3_hosts_paths_rules(spark):
    urls = [None, "", "no scheme/en/", "http://Example.COM/en/7", "http://x.com/en/", "http://xcom/en/", "http://a.example.com/en/70?q", "http://example.net/de/8#x", "http://q.net/de/1", "http://net/de/", "http://o.org/es/9", "http://o.org/ES/9", "http://h?x=1://y/z", "a://b://c/en/", "http://u@h.com:80/en/", "http://\nx.org/es/\n?", "https://h.com#/en/"]
    rows = url_filter.op3(spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")).collect()
    verdicts = {h + p: v for h, p, v in url_filter.RULES}
    for r in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [h + p for h, p, _ in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=len, default=None)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (r.verdict == verdicts[rule] if rule else r.verdict in ("allow", "block"))
    assert url_filter.op3(spark.createDataFrame([], "page_id long, url string")).count() == 0


def made_urls(n, seed):
    """Blocked URLs are long, deep, full of digits or parameters, or of some hosts; a few are neither."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = i % 2
        host = rng.choice(["shop1.win.biz", "x.win.biz", "deal.org"] if bad else ["news.org", "a.edu.net", "blog.edu.net", "deal.org"])
        path = "/".join("".join(rng.choice("0123456789" if bad and rng.random() < 0.8 else "abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 6 if bad else 3)))
        query = "&".join(f"p{k}={rng.randint(1, 99)}" for k in range(rng.randint(1, 5) if bad and rng.random() < 0.8 else 0))
        out.append((f"https://{host}/{path}" + (f"?{query}" if query else ""), host, "/" + path, bad))
    return out


def test_trees_tell_urls_they_did_not_learn_from():
    model, fresh = url_filter.Model(made_urls(1500, 1)), made_urls(800, 2)
    scores = model.scores([r[:3] for r in fresh])
    assert np.mean((scores >= 0.5) == np.array([r[3] == 1 for r in fresh])) >= 0.95
    # its own label is no feature of a row: hosts of one URL each tell nothing
    alone = url_filter.Model([(f"http://h{i}x.q{i}/a", f"h{i}x.q{i}", "/a", i * 7919 % 2) for i in range(400)])
    assert all(abs(s - 0.5) < 0.4 for s in alone.scores([("http://new.q/a", "new.q", "/a")]))


def test_bar_and_held_out_urls_of_the_tables(spark):
    rows = [tuple(r) for r in url_filter.labelled(table(spark, "/root/testdata/sf0.1", "pages")).select("url", "host", "path", "kind").collect()]
    learn, fresh = [r for r in rows if url_filter.fold(r[0]) != 1], [r for r in rows if url_filter.fold(r[0]) == 1]
    model = url_filter.calibrated(learn)
    shares = [np.mean([s >= model.bar for r, s in zip(fresh, model.scores([r[:3] for r in fresh]), strict=True) if r[3] == kind]) for kind in url_filter.KINDS]
    assert model.bar >= 0.5 and shares[url_filter.BLOCKED] > 1.5 * shares[url_filter.UNRULED] and shares[url_filter.UNRULED] < 0.2


def test_op3_learns_from_all_urls_however_they_are_dealt(spark):
    # the few URLs of one host are told from the others only if all of the 16,000 are counted
    rows = [r for i in range(8) for r in made_urls(2000, 10 + i)]
    rows = [(*r[:3], url_filter.BLOCKED if r[3] else i % 4 and url_filter.UNRULED) for i, r in enumerate(rows)]
    marked = spark.createDataFrame(rows, "url string, host string, path string, kind int")
    local, counts = url_filter.calibrated(rows), url_filter.suffix_counts(marked)
    assert counts.sum() == 3 * len(rows) and counts[:, :, url_filter.BLOCKED].sum() == 3 * 8000
    for parts in (2, 7):
        model = url_filter.fit(marked.repartition(parts))
        assert np.allclose(model.stats, local.stats) and all((a == b).all() for a, b in zip(model.cuts, local.cuts, strict=True))
        assert [levels for levels, _ in model.trees] == [levels for levels, _ in local.trees] and model.bar == local.bar
        fresh = [r[:3] for r in made_urls(300, 99)]
        assert (model.scores(fresh) == local.scores(fresh)).all()


def test_op3_without_one_of_the_kinds(spark):
    none = [(1, None), (2, ""), (3, "no host"), (3, "no host"), (None, "http://b.org/es/x")]
    for rows in ([], none[:4], none, [(1, "http://a.com/en/1")]):
        found = url_filter.op3(spark.createDataFrame(rows, "page_id long, url string")).collect()
        assert len(found) == len(rows) and all((r.verdict == "block") == (r.rule is not None) for r in found)


def test_queries_of_pairs_on_the_test_tables(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert collections.Counter(map(tuple, queries.queries()["op8_ngram_jaccard"](spark, SF).collect())) == brute_components(docs)
    pages = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").collect()]
    found = queries.queries()["op1_warc_segments"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collections.Counter(map(tuple, found.collect())) == brute_pages(pages)


def test_pipeline_against_brute_force(spark):
    """Every stage on what the one before it kept: votes by all cosines, rules row by row, links by all pairs, pieces by the
    tokenizer; then run() as a whole."""
    docs = table(spark, SF, "documents")
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    before = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        before.append(docs)
        docs = spark.read.parquet(path)
        assert docs.columns == names
    before.append(docs)
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in before]
    labels = table(spark, SF, "labels")

    model = quality_knn.fit(before[0], labels)
    vectors = model.project(quality_knn.weighted(quality_knn.term_counts([t or "" for _, t in rows[0]]), model.idf)).astype(float)
    cosines = np.clip(vectors @ model.vectors.T.astype(float), 0, None)
    near = np.argsort(-cosines, axis=1, kind="stable")[:, : min(quality_knn.NEIGHBOURS, cosines.shape[1])]
    weight = np.take_along_axis(cosines, near, 1) ** 4 * model.votes[near]
    score = np.where(weight.sum(1) > 0, (weight * model.labels[near]).sum(1) / np.maximum(weight.sum(1), 1e-300), model.prior)
    sure = np.abs(score - 0.5) > 1e-3
    kept = {i for i, _ in rows[1]}
    assert all((i in kept) == (s >= 0.5) for (i, _), s, ok in zip(rows[0], score, sure, strict=True) if ok)

    rules = quality_rules.learn_from(before[1], labels)
    features = {r.doc_id: r.asDict() for r in quality_rules.statistics(before[1].select("doc_id", "text")).collect()}
    assert {i for i, _ in rows[2]} == {i for i, f in features.items() if not f["base_failed"] and not any(rule.holds(f) for rule in rules)}

    want = {c for _, _, c in brute_components(rows[2])}
    assert sorted(i for i, _ in rows[3]) == sorted(want)

    found = corpus_pipeline.run(spark, SF).collect()
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, places = collections.Counter(), collections.defaultdict(list)
    for i, t in rows[3]:
        ids = [*words.encode(t or "", add_special_tokens=False).ids, 0]
        pieces.update((i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert len(places) <= -(-sum(n for _, _, _, n, _ in pieces.elements()) // 2048) + 1


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
