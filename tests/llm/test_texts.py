"""Token counts, byte BPE, packing and licences against the libraries and brute force."""

import base64
import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers as P
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kindred.llm import byte_bpe, common, licenses, packing, token_counts
from kindred.session import scratch, table

PIECES, RANKS, WORDS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TT = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.parse_ranks(open(RANKS, "rb").read()), special_tokens={})
HF = Tokenizer.from_file(WORDS)
ODD = st.text(st.one_of(st.sampled_from(list("aA bé's12!\n\t  ▁\x1c\x85\u3000İſ<|>")), st.characters(codec="utf-8")), max_size=60)
COUNTER, CODEC, IDS = token_counts.PieceCounter(open(PIECES, "rb").read()), byte_bpe.ByteCodec(open(RANKS, "rb").read(), P.PATTERN), packing.WordIds(open(WORDS, "rb").read())


@given(st.lists(ODD, max_size=4))
@settings(max_examples=300, deadline=None)
def test_counts_are_the_librarys(texts):
    assert COUNTER.by_word and COUNTER.counts(texts) == [len(SP.encode(t)) for t in texts]


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_byte_ids_are_the_librarys(text):
    ids = TT.encode_ordinary(text)
    assert CODEC.encode(text) == ids and CODEC.decode(ids) == text.encode()
    assert CODEC.digests([text])[0] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_word_ids_are_the_librarys(text):
    ids = HF.encode(text, add_special_tokens=False).ids
    assert IDS.ids([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


def test_plain_texts_are_looked_up_by_pre_tokens_whatever_marks_their_words_have():
    own = packing.WordIds(open(WORDS, "rb").read())
    marks = [*"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~×÷", "...", "'!", "!'s", "'S", "''ll", "'t5'", "12's", "’"]
    texts = [f"{a}Naïve{b}{c} DON{b}t{a}" for a in marks for b in marks for c in ("", "\n", ".\v")]
    assert own.ids(texts) == [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in HF.encode_batch(texts, add_special_tokens=False)]
    # only words of texts with odd characters or "<|" are held as they stand
    held = len(own.memo.new)
    own.ids([f"alpha{a} (beta{b}" for a in "!?.,;" for b in "!?.,;"])
    assert len(own.memo.new) == held and {"alpha", "beta"} <= own.pre_tokens.new.keys()


def test_a_lookup_does_not_go_through_all_that_a_memo_holds():
    class Held(dict):
        def keys(self):
            raise AssertionError("all keys")

    memo = common.Memo(lambda keys: [k * 2 for k in keys], 4)
    memo.new, memo.old = Held({1: 2, 2: 4}), Held({3: 6})
    assert memo.values([5, 3, 1]) == [10, 6, 2] and memo.values([3, 3, 7]) == [6, 6, 14]


def test_slices_of_long_texts(monkeypatch, words):
    text = "  ".join(words * 3) + "\n " + " ".join(words)
    for module, value in ((token_counts, 500), (byte_bpe, 500), (packing, 500)):
        monkeypatch.setattr(module, "SLICE", value)
    assert COUNTER.counts([text]) == [len(SP.encode(text))]
    assert CODEC.digests([text, "a b"])[0][0] == len(TT.encode_ordinary(text)) and CODEC.digests([text, "a b"])[1][0] == 2
    ids = HF.encode(text, add_special_tokens=False).ids
    assert IDS.ids([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


def test_perfect_hash_finds_its_keys_and_no_others():
    keys = list(CODEC.ranks)[:5000]
    own = byte_bpe.PerfectHash(keys)
    assert sorted(map(own.slot, keys)) == list(range(5000)) and own.slot(b"no such key") == -1
    assert byte_bpe.PerfectHash([]).slot(b"x") == -1 and byte_bpe.PerfectHash([b"x"]).slot(b"x") == 0


def test_op7_over_odd_texts_and_its_cache(spark, docs, odd_texts, none):
    want = sorted(((i if i is not None else -1), len((t or "").encode()), len(SP.encode(t or ""))) for i, t in odd_texts)
    cache = scratch(spark, "cache")
    for known in (False, True):
        rows = token_counts.count_tokens(docs, PIECES, cache).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.cached == known for r in rows)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in odd_texts}) == stored.select("content_digest").distinct().count()
    assert token_counts.op7(spark, none, PIECES).count() == 0


def test_op10_over_odd_texts(spark, docs, odd_texts, none):
    rows = byte_bpe.code_digests(docs, RANKS, P.PATTERN).collect()
    want = collections.Counter((i, len(ids := TT.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in odd_texts)
    assert collections.Counter(map(tuple, rows)) == want
    assert byte_bpe.code_digests(none, RANKS, P.PATTERN).count() == 0
    both = byte_bpe.decode(byte_bpe.encode(docs.limit(5).select("doc_id", "text"), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in both)


def pieces_of(texts, capacity=2048):
    out = collections.Counter()
    for i, t in texts:
        ids = [*HF.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            own = ids[k : k + capacity]
            out[i, k // capacity, k, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))] += 1
    return out


def gapless(rows, capacity):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_op9_over_odd_texts(spark, docs, odd_texts, none):
    rows = packing.pack(docs, WORDS, 2048, 0, with_ids=True).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces_of(odd_texts)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    assert gapless(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1
    assert packing.pack(none, WORDS).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
@settings(max_examples=200, deadline=None)
def test_plans_hold_every_piece_once(counts):
    bins = packing.plan(counts, 64)
    held = collections.Counter()
    for own, times in bins:
        assert sum(n * c for n, c in own.items()) <= 64
        for n, c in own.items():
            held[n] += c * times
    assert dict(held) == counts
    table = packing.slots(bins)
    places = collections.defaultdict(list)
    for n, c in counts.items():
        for rank in range(c):
            sequence, offset = packing.lookup(table, n, rank)
            places[sequence].append((offset, n))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), min_size=1, max_size=8), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_fullest_combination_is_the_fullest(counts, room):
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    chosen = packing.fullest(counts, room)
    assert sum(chosen) == max(s for s in sums if s <= room) and not collections.Counter(chosen) - collections.Counter(counts)


def base_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({label for _, label in found}))


def test_op5_over_odd_texts(spark, docs, odd_texts, none):
    rows = licenses.op5(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == collections.Counter((i, *base_of(t)) for i, t in odd_texts)
    assert all(0 <= r.score <= 1 for r in rows) and licenses.op5(none).count() == 0


def test_licence_places_overlap_and_templates_are_found(spark):
    mit = licenses.TEMPLATES["mit"][0]
    texts = ["Apache License, apache LICENSE; MIT-license cc by/cc by", "GNU General\nPublic License MIT license", f"x {mit.title()} y", mit.replace("charge", "cost"), "mit licensed and apache licenses", "The MIT"]
    rows = {r.doc_id: r for r in licenses.op5(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[i]) for i, r in rows.items())
    assert rows[0].n_base == 5 and rows[2].labels == "mit" and rows[2].score == 1 and rows[2].base_labels == ""
    assert rows[3].labels == "mit" and 0.9 < rows[3].score < 1 and rows[5].labels == "" and rows[5].score == 0


def brute_cover(scanner, tokens):
    """Spans by trying all places, chains by comparing all pairs of spans."""
    templates = [own for _, own in scanner.templates]

    def longest(i):
        """The longest template part that ends before token i, and any of its places."""
        best = (0, 0, 0)
        for k, own in enumerate(templates):
            for stop in range(1, len(own) + 1):
                n = 0
                while n < min(stop, i) and own[stop - 1 - n] == tokens[i - 1 - n]:
                    n += 1
                best = max(best, (n, k, stop))
        return best

    ends = [longest(i) for i in range(1, len(tokens) + 1)]
    spans = [(i + 1 - n, tokens[i + 1 - n : i + 1]) for i, (n, _, _) in enumerate(ends) if n >= scanner.min_match and (i + 1 == len(ends) or ends[i + 1][0] <= n)]
    out = {}
    for label, own in scanner.templates:
        placed = sorted((w, at, len(part)) for w, part in spans for at in range(len(own)) if own[at : at + len(part)] == list(part))
        total = []
        for w, at, n in placed:
            total.append(n + max((c for (v, t, m), c in zip(placed, total, strict=False) if v + m <= w and t + m <= at), default=0))
        if total:
            out[label] = max(out.get(label, 0), max(total) / len(own))
    return out


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(1, 12)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_cover_is_the_best_chain(pieces):
    scanner = licenses.Scanner({"a": ["p q r p q s t", "x y"], "b": ["q r p q p q r", "t u v t u w"], "c": ["p q r s t u v"]}, min_match=2)
    tokens = []
    for k, at, n in pieces:  # parts of templates, with a strange word here and there
        own = scanner.templates[k][1]
        tokens += (own[at % len(own) :][:n] if at % 7 else [0])
    tokens = np.array(tokens, np.int32)
    assert scanner.cover(scanner.spans(tokens)) == brute_cover(scanner, tokens.tolist())


def test_op5_labels_and_scores_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    scanner = licenses.Scanner()
    found = {r.doc_id: r for r in licenses.op5(docs).collect()}
    seen = 0
    for doc_id, text in ((r.doc_id, r.text) for r in docs.collect()):
        tokens = scanner.tokens(text or "")
        near = np.flatnonzero(tokens)
        if not len(near):
            assert found[doc_id].labels == "" and found[doc_id].score == 0
            continue
        cover, base = brute_cover(scanner, tokens.tolist()) if len(near) < 400 else None, base_of(text)
        if cover is not None:
            seen += bool(cover)
            own = set(filter(None, base[-1].split(","))) | {label for label, share in cover.items() if share >= licenses.MIN_COVER}
            assert found[doc_id].labels == ",".join(sorted(own))
            assert abs(found[doc_id].score - max([0.0, *cover.values(), 0.5 if base[1] else 0.0])) < 1e-12
    assert seen > 3


def test_many_notices_take_no_quadratic_work():
    import time

    scanner, text = licenses.Scanner(), "licensed under the apache license version 2 0 x "
    began = time.process_time()
    tokens = scanner.tokens(text * 40_000)
    cover = scanner.cover(scanner.spans(tokens))
    assert cover["apache-2.0"] == 1 and time.process_time() - began < 20


@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=8), min_size=1, max_size=3), st.lists(st.integers(1, 5), max_size=15))
@settings(max_examples=300, deadline=None)
def test_matching_statistics(templates, text):
    own = licenses.SuffixAutomaton(templates)
    factors = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for at, (length, state) in enumerate(own.statistics(text)):
        assert length == max((n for n in range(at + 2) if not n or tuple(text[at + 1 - n : at + 1]) in factors))
        if length:
            k, stop = own.place[state]
            assert templates[k][stop - length : stop] == text[at + 1 - length : at + 1]


def test_ranks_of_the_file():
    lines = open(RANKS, "rb").read().splitlines()
    assert CODEC.ranks[base64.b64decode(lines[500].split()[0])] == int(lines[500].split()[1])
