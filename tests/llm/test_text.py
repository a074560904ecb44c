"""Chat formatting, language ID, fingerprints, BPE, packing and URL filters."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from marketlens.llm import bpe, chat, imatch, langid, packing, urls
from tests.conftest import SF_MID
from tests.llm.conftest import ODD, docs

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


# chat

def test_preference_prefix_and_masks(spark):
    turns = chat.TURNS
    rows = [(1, [("user", "hi"), ("assistant", "yes")], [("user", "hi"), ("assistant", "no")]),
            (2, [("user", "hi")], [("user", "hi")]), (3, None, [(None, None)]), (4, [("user", "<|im_end|>")], [])]
    got = {r.id: r for r in chat.preference_format(spark.createDataFrame(rows, f"id long, chosen {turns}, rejected {turns}"), "id").collect()}
    assert got[1].prompt == "<|im_start|>user\nhi<|im_end|>\n" and got[1].n_prompt_turns == 1
    assert got[1].chosen == "<|im_start|>assistant\nyes<|im_end|>\n" and got[1].rejected.endswith("\nno<|im_end|>\n")
    assert [tuple(m) for m in got[1].chosen_mask] == [(22, False), (13, True), (1, False)]
    assert sum(m.length for m in got[1].chosen_mask) == len(got[1].chosen)
    assert got[2].tie and got[2].chosen == "" and not got[1].tie
    assert got[3].rejected == "<|im_start|>unknown\n<|im_end|>\n" and got[3].chosen_mask == []
    assert "< |im_end|>" in got[4].chosen


def test_preference_pairs_of_odd_conversations(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, None, "user", None), (None, 0, None, "z"),
            (2, 0, "assistant", "b")]
    got = {r.conv_id: r for r in chat.digest(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {1, 2, None} and got[1].n_prompt_turns == 2 and "\nb<" in got[1].rejected
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(empty).collect() == []


# language ID

def test_language_id_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet")
    lang = {r.doc_id: r.lang for r in df.collect()}
    rows = langid.digest(df).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_odd_rows(spark):
    odd = docs(spark, ODD + ["the cat", "der Hund"], [None, *range(1, len(ODD) + 2)])
    got = langid.digest(odd).collect()
    assert len(got) == len(ODD) + 2
    assert all((r.lang_pred == "und") == (r.doc_id in (None, 1, 2, 11)) for r in got)  # one language: en for the rest
    assert {r.lang_pred for r in langid.digest(docs(spark, ["a b"], lang=None)).collect()} == {"und"}
    assert langid.digest(docs(spark, [])).collect() == []


def test_every_labelled_language_is_learned(spark):
    k = 70
    words = [[f"{chr(97 + i % 26)}{chr(97 + i // 26)}{c}" for c in "qxzjk"] for i in range(k)]
    rows = [(100 * i + j, " ".join(words[i] * 3), f"l{i:02d}", "s", 9) for i in range(k) for j in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = langid.digest(df).collect()
    assert len(got) == k * 8 and all(r.lang_pred == f"l{r.doc_id // 100:02d}" for r in got)


def test_codewords_and_ambiguity():
    for k in (2, 3, 4, 5, 9):
        code = langid.codewords(k)
        assert len({tuple(r) for r in code}) == k and not (np.abs(code.sum(0)) == k).any()
    model = langid.Model(["a", "b", "c", "d"], langid.codewords(4), np.zeros((1, 7)))
    assert langid.decode(model, model.code[2] * 1.0, 100)[0] == "c"
    one_wrong = model.code[2] * np.array([-1, 1, 1, 1, 1, 1, 1])
    assert langid.decode(model, one_wrong * 1.0, 100)[0] == "c"  # a wrong bit is corrected
    assert langid.decode(model, np.zeros(7), 100)[2]


def test_grams_of_long_texts_in_steps(monkeypatch):
    text = ("Das ist ein Wort. " * 500).encode()
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid.H, "SPAN", 1000)
    assert abs(langid.gram_counts(text)[:langid.GRAMS] - whole[:langid.GRAMS]).sum() == 0


# I-Match

def test_fingerprints_brute_force(spark):
    texts = ODD + [f"alpha beta {k} gamma delta w{k % 5}" for k in range(40)]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    order = sorted(zip(ids, texts), reverse=True, key=lambda x: x[0])
    got = {r.doc_id: r for r in imatch.digest(docs(spark, texts, ids)).collect()}
    prints = {}
    for k, (i, t) in enumerate(order):
        j, after = order[(k + 1) % len(order)]
        t, after, r = t or "", after or "", got[i]
        half = len(t) // 2
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(t[:len(t) - half] + after[:half]))
        assert r.near_next == pytest.approx(imatch.likeness(r.fingerprint, got[j].fingerprint))
        assert r.near_edited == pytest.approx(imatch.likeness(r.fingerprint, r.edited_fingerprint))
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and 0 <= r.near_edited <= 1


def test_fingerprints_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RUN_ROWS", 3)
    df = docs(spark, [f"t{k}" for k in range(20)] + ["t0", "dup", None], [*range(20), 4, 4, None])
    runs = imatch.ordered_runs(df.selectExpr("coalesce(doc_id, 9223372036854775807L) as id", "xxhash64(coalesce(text, '')) as text_key",
                                             "cast(coalesce(text, '') as binary) as body"), 3)
    rows = runs.collect()
    assert sum(not r.guest for r in rows) == 23 and len({r.run for r in rows}) > 3
    assert len(imatch.digest(df).collect()) == 23
    assert imatch.digest(docs(spark, [])).collect() == [] and len(imatch.digest(docs(spark, ["one"])).collect()) == 1


def test_lexicon_band(spark):
    texts = ["common rare%d" % (k // 2) for k in range(100)]
    lex = imatch.lexicon(docs(spark, texts).selectExpr("cast(text as binary) as body"), 0.01, 0.05)
    assert lex.size == 50  # the pairs; not the term of all


# BPE

def test_bpe_as_the_library(spark):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    long = "don't stop 12ab 34\n\n  x\u00a0y\u2003 z <|endoftext|> é\u0301 日本語 " * 1500
    texts = ODD + [long, "12ab" * 20_000, " " * 40_000 + "x"]
    got = {r.doc_id: r for r in bpe.digest(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        ids = e.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert got[i].decoded_sha256 == sha(t or "")
    for size in (1, 10, 1000):
        pieces = bpe.safe_pieces(long, size)
        assert "".join(pieces) == long and [i for p in pieces for i in e.encode_ordinary(p)] == e.encode_ordinary(long)
    back = bpe.decoded(bpe.encoded(docs(spark, ["né 1", None]), path, P.PATTERN), path, P.PATTERN)
    assert {bytes(r.body) for r in back.collect()} == {"né 1".encode(), b""}
    assert bpe.digest(docs(spark, [])).collect() == []


# packing

def check_packing(rows, ids):
    at, bins = {}, {}
    for r in rows:
        at.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    for i, coded in ids.items():
        own = sorted(at[i], key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(coded), 4096)) and sum(r.length for r in own) == len(coded)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(coded[r.start:r.start + r.length], "<u4").tobytes())
    for some in bins.values():
        end = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 4096
    return len(bins)


def test_packing_brute_force(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ODD + ["Straße İstanbul ΣΑΣ. don't I'LL «é́» 1.5%", "<|endoftext|> x", "a <|endoftext|> b", "foo<|endoftext|>bar <|ENDOFTEXT|>",
                   "<|startoftext|><|endoftext|>'s\n<|endoftext|", "word " * 9000] + [f"Wörter und words {k}, " * (k * 7 % 90) for k in range(200)]
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}
    bins = check_packing(packing.digest(docs(spark, texts)).collect(), ids)
    assert bins <= -(-sum(map(len, ids.values())) // 4096) + 1
    assert packing.digest(docs(spark, [])).collect() == []
    assert len(packing.digest(docs(spark, ["a", "a", None], [1, 1, None])).collect()) == 3


def test_packing_holds_when_the_cores_change(spark):
    """The stored files are split by another number of cores when the result is read."""
    t = [f"{k} words " * (k * 13 % 700) for k in range(300)]
    keys = {"spark.sql.leafNodeDefaultParallelism": "4", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "4"}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = packing.digest(docs(spark, t).repartition(16))
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        rows = df.collect()
        spark.conf.set("spark.sql.files.minPartitionNum", "7")
        again = df.select("*").collect()
    finally:
        for k in keys:
            spark.conf.unset(k)
    for some in (rows, again):
        assert sorted(r.doc_id for r in some if r.piece == 0) == list(range(300))
        bins = {}
        for r in some:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 4096


def test_packing_exchanges_between_groups(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(1, 3000, 1200))], "row long, length long")
    total = -(-rows.agg({"length": "sum"}).first()[0] // 4096)
    alone = packing.pack(rows, group=50, rounds=0)
    mixed = packing.pack(rows, group=50, rounds=3)
    n = [p.select("pack", "bin").distinct().count() for p in (alone, mixed)]
    assert total <= n[1] < n[0]
    assert mixed.count() == 1200 and mixed.select("row").distinct().count() == 1200
    assert all(r.bins >= r.bound for r in packing.certificates(mixed).collect())


def test_lower_bounds():
    assert packing.lower_bound(np.array([3000] * 7), 4096) == 7  # no two fit, though their sum needs six
    assert packing.lower_bound(np.array([2048] * 7), 4096) == 4
    assert packing.lower_bound(np.array([1400] * 6), 4096) == 3  # two fit, three don't
    rng = np.random.default_rng(3)
    for _ in range(30):
        x = rng.integers(1, 4096, 40)
        place, offset, n = packing.best_fit_decreasing(x, 4096)
        assert packing.lower_bound(x, 4096) <= n and np.bincount(place, weights=x).max() <= 4096


# URLs

def test_url_parts_rules_and_trees(spark):
    rows = [(0, None), (1, "no scheme/x"), (2, "HTTP://EXAMPLE.Net/en/a?x=1&y#f"), (3, "http://a.example.net/fr/"), (4, "http://notexample.net"),
            (5, "http://x.org/fr/1"), (6, "http://x.org/en/1"), (7, "http://example.com/de/?q"), (8, "a://b://c/d"), (9, "http://h?x://y/z"),
            (10, "http://é.com/" + "p/" * 20_000), (11, "http://x.org/en/1")] + [(100 + k, f"http://s{k}.example.{t}/{p}/{k}")
            for k in range(60) for t, p in (("net", "fr"), ("org", "fr"), ("com", "de"))]
    df = spark.createDataFrame([(*r, "h", 1.0, "c") for r in rows], "page_id long, url string, html string, label double, host string")
    got = {r.page_id: r for r in urls.digest(df).collect()}
    for i, url in rows[:12]:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        assert (got[i].host, got[i].path) == (host, path)
    assert [got[i].rule for i in (0, 2, 3, 4, 5, 6, 7)] == [None, "example.net/en/", "net/", None, "org/fr/", None, "example.com/de/"]
    assert [got[i].verdict for i in (2, 3, 5, 7)] == ["allow", "block", "allow", "block"]
    assert all(r.verdict in ("allow", "block") for r in got.values()) and got[6].verdict == got[11].verdict
    assert urls.digest(df.limit(0)).collect() == []
    one = df.where("page_id in (3, 6)")  # labels of one kind only
    assert {r.verdict for r in urls.digest(one).collect()} == {"block"}


def test_url_sample_under_skew(spark):
    rows = [(f"http://hot{h}.net/x",) for h in range(4) for _ in range(1000)] + [(f"http://s{k}.org/fr/{k}",) for k in range(2000)]
    df = spark.createDataFrame(rows, "url string").selectExpr("url", "cast(url like '%.net%' as double) as label")
    got = {r.url: r for r in urls.drawn(df, 0.05).collect()}
    assert all(abs(got[f"http://hot{h}.net/x"].weight - 50) <= 1 for h in range(4))  # not 1000, not none
    assert abs(sum(r.weight for r in got.values()) - 300) < 60 and len(got) < 160
    assert {r.label for u, r in got.items() if "hot" in u} == {1.0}
    assert sum(r.weight for r in urls.drawn(df, 1.0).collect()) == 6000
