"""Line, exact, near and substring deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from marketlens.llm import exact, hashing as H, linededup, near, repeats, substring
from marketlens.llm.components import components
from tests.llm.conftest import ODD, docs

SPACE = re.compile(r"[\x20\x09-\x0D]+")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def split(t):
    return [w for w in SPACE.split(t or "") if w]


def corpus(seed=3, n=120):
    """Copies, near copies and shared passages of random words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(70)]
    out = list(ODD)
    for k in range(n):
        if k % 4 == 0 or len(out) < 20:
            t = [word() for _ in range(rng.randint(5, 200))]
        elif k % 4 == 1:
            t = split(rng.choice(out))
        elif k % 4 == 2:
            t = split(rng.choice(out))
            for _ in range(rng.randint(0, 1 + len(t) // 12)):
                if t:
                    t[rng.randrange(len(t))] = word()
        else:
            t = [word() for _ in range(30)] + passage[:rng.randint(49, 70)] + [word() for _ in range(20)]
        out.append(rng.choice([" ", "\n", "  "]).join(t) if t else "")
    return out


def test_substring_brute_force(spark):
    texts = corpus()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    first = {}
    for i, t in zip(ids, texts):
        w = split(t)
        for k in range(len(w) - 49):
            x = tuple(w[k:k + 50])
            first[x] = min(first.get(x, i), i)
    got = {r.doc_id: r for r in substring.digest(docs(spark, texts, ids)).collect()}
    removed = 0
    for i, t in zip(ids, texts):
        w = split(t)
        gone = {p for k in range(len(w) - 49) if first[tuple(w[k:k + 50])] < i for p in range(k, k + 50)}
        removed += len(gone)
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    assert removed > 200


def test_substring_intervals_and_null_ids(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), "y " + " ".join(words[:55]), " ".join(words)]
    rows = substring.remove_repeated_windows(docs(spark, texts, [1, 2, None]), untouched=True).collect()
    got = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in got[2].removed] == [(1, 56)] and got[2].kept == "y"
    assert got[None].n_removed == 60 and got[1].n_removed == 0 and got[1].kept == texts[0]


def test_covered_starts_are_distinct(spark):
    """Rows that repeat id and text don't make each other's list longer."""
    text = " ".join(f"w{k}" for k in range(60))
    df = docs(spark, [text] * 6, [1] + [None] * 5)
    full = df.select(repeats.whole_id("doc_id"), repeats.whole_text("text"), repeats.text_key("text"))
    got = repeats.covered(full, H.WHITE, 50, 16, True).collect()
    assert [r.starts for r in got] == [list(range(11))]
    assert sorted(r.n_removed for r in substring.digest(df).collect()) == [0] + [60] * 5


def repeated_lines(rows, chars):
    """(id, text) -> per row (lines, removed, kept), from the definition: minimal
    windows, their first places, and the loose lines beside them."""
    docs_, seen = [], {}
    for k, (i, t) in enumerate(rows):
        w = [x for x in (t or "").split("\n") if x]
        windows = []
        for a in range(len(w)):
            b = next((b for b in range(a, len(w)) if sum(map(len, w[a:b + 1])) >= chars), None)
            if b is not None:
                windows.append((a, b))
        windows = [x for n, x in enumerate(windows) if n + 1 == len(windows) or windows[n + 1][1] > x[1]]
        prints = []
        for n, (a, b) in enumerate(windows):
            left = w[windows[n - 1][1] + 1 if n else 0:a][::-1]
            right = w[b + 1:windows[n + 1][0] if n + 1 < len(windows) else len(w)]
            prints.append((a, b, left, right))
        docs_.append((i, t, w, prints))
    for i, t, w, prints in sorted(docs_, key=lambda d: (d[0] is None, d[0] or 0)):
        for a, b, left, right in prints:
            seen.setdefault(tuple(w[a:b + 1]), ((i, t, a), left, right))
    same = lambda x, y: next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    out = []
    for i, t, w, prints in docs_:
        gone = set()
        for a, b, left, right in prints:
            place, left0, right0 = seen[tuple(w[a:b + 1])]
            if place != (i, t, a):
                gone |= set(range(a - same(left, left0), b + 1 + same(right, right0)))
        out.append((i, len(w), len(gone), "\n".join(x for p, x in enumerate(w) if p not in gone) if gone else t or ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("chars", [1, 6, 20])
def test_lines_brute_force(spark, chars):
    rng = random.Random(chars)
    pool = [rng.choice(["", "a", "bc", "Of.", "é", "line %d" % k, "a longer line number %d" % k, "ünïcödé %d" % k]) for k in range(60)]
    texts = [None, "", "\n\n", "a\r\nb", "x" * 50, "a\n" * 3000]
    for _ in range(150):
        t = [rng.choice(pool) for _ in range(rng.randint(0, 25))]
        if texts and rng.random() < 0.6:
            other = (rng.choice(texts) or "").split("\n")
            lo = rng.randrange(len(other))
            t[len(t) // 2:len(t) // 2] = other[lo:lo + rng.randint(1, 8)][:40]
        texts.append("\n".join(t))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    got = linededup.remove_repeated_lines(docs(spark, texts, ids).repartition(3), chars=chars)
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in got.collect()), key=str) == repeated_lines(rows, chars)


def test_single_lines_and_their_neighbours_go(spark):
    line = "All rights are reserved by the author."
    texts = [f"one\n{line}\nOf.\nmore", f"two\n{line}\nOf.\nless", f"one\n{line}", line, "one\nOf."]
    got = {r.doc_id: (r.kept, [tuple(x) for x in r.removed]) for r in linededup.remove_repeated_lines(docs(spark, texts)).collect()}
    assert got[1] == ("two\nless", [(1, 3)])  # the short line beside it stood there at the first place too
    assert got[2] == ("", [(0, 2)]) and got[3] == ("", [(0, 1)])
    assert got[4] == ("one\nOf.", [])  # short lines alone stay


def test_runs_of_short_lines_go(spark):
    short = [f"item {k}" for k in range(8)]
    texts = ["\n".join(short), "head\n" + "\n\n".join(short[2:]) + "\ntail"]
    got = {r.doc_id: r.kept for r in linededup.remove_repeated_lines(docs(spark, texts)).collect()}
    assert got[0] == texts[0] and got[1] == "head\ntail"


def test_lines_of_documents_that_share_an_id(spark):
    """Null ids, or one id, with different texts: the same run at the same line."""
    line = "a line of more than twenty characters"
    for i in (None, 7):
        rows = linededup.remove_repeated_lines(docs(spark, [f"{line}\nd", f"{line}\ne"], [i, i])).collect()
        assert sorted(r.n_removed for r in rows) == [0, 1]
    rows = linededup.remove_repeated_lines(docs(spark, [f"{line}\nd"] * 2, [None, None])).collect()
    assert [r.n_removed for r in rows] == [0, 0]  # one document
    rows = linededup.remove_repeated_lines(docs(spark, [f"{line}\n{line}\nd"] * 2, [5, 5])).collect()
    assert [r.n_removed for r in rows] == [1, 1]  # a repeat inside it
    assert linededup.remove_repeated_lines(docs(spark, [])).collect() == []


def test_exact_brute_force(spark):
    texts = corpus(5) + ["a b", "a\tb "]
    ids = [*range(len(texts) - 2), None, 3]  # a null and a repeated id
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i if i is not None else 1 << 63, i))
    rows = exact.digest(docs(spark, texts, ids)).collect()
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in rows)
    want = sorted((str(i), min(groups[SPACE.sub("", t or "")])[2], len(groups[SPACE.sub("", t or "")]), sha(SPACE.sub("", t or "")))
                  for i, t in zip(ids, texts))
    assert got == want
    assert sum(r.kept for r in rows) == len(groups)


def test_exact_keeps_one_of_repeated_rows(spark):
    df = docs(spark, ["a b", "a b", "ab", "c"], [1, 1, 2, 3])
    kept = exact.exact_dedup(df)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns == df.columns


def test_exact_collisions_are_told_apart(spark):
    rows = [(0, 5, "0-0", bytearray(b"x")), (0, 5, "0-1", bytearray(b"y")), (0, 5, "1-0", bytearray(b"x"))]
    got = {r.entry: r["class"] for r in exact.owners(spark.createDataFrame(rows, "bucket int, key long, entry string, body binary"), 1).collect()}
    assert got["0-0"] == got["1-0"] != got["0-1"]


def test_directory_splits():
    counts = np.zeros(16, np.int64)
    counts[3], counts[12] = 10, 5
    slots, depth = exact.split_directory(counts, 8)
    assert depth == 4 and slots[3] != slots[2] and len(set(slots[8:])) == 1
    assert (np.diff(slots) >= 0).all()
    assert exact.split_directory(counts * 0, 8)[1] == 0


@pytest.mark.parametrize("words", [2, 5])
def test_near_brute_force(spark, words):
    texts = corpus(9)
    sets = []
    for t in texts:
        w = split("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    got = {r.id: r for r in near.near_groups(docs(spark, texts), words=words).collect()}
    assert {i: got[i].component for i in got} == {i: top(i) for i in range(len(texts))}
    assert all(got[i].n_shingles == len(s) for i, s in enumerate(sets))


def test_near_blocks_settle_what_pivots_miss(spark, monkeypatch):
    """With a pivot test that never links, the blocks alone find all links."""
    df = docs(spark, corpus(11, 60))
    want = {r.id: r.component for r in near.near_groups(df, words=2).collect()}
    monkeypatch.setattr(near, "_possible", lambda similarity: "false")
    assert {r.id: r.component for r in near.near_groups(df, words=2).collect()} == want


def test_near_keeps_one_where_ids_repeat(spark):
    words = [f"w{k}" for k in range(100)]
    near_copies = [" ".join([*words[:99], end]) for end in ("a", "b", "c")]
    for ids in ([None, None, None], [5, 5, 9]):
        df = docs(spark, [*near_copies, near_copies[0], "alone here", "other text", None, None], [*ids, ids[0], None, 5, None, None])
        got = [r.text for r in near.near_dedup(df).collect()]
        assert sum(t in near_copies for t in got) == 1 and len(got) == 5
        assert {"alone here", "other text"} <= set(got) and got.count(None) == 2


def test_odd_sketch_estimates(spark):
    rng = np.random.default_rng(0)
    for share in (0.8, 0.9, 0.95):
        a = H.mix(rng.integers(1, 1 << 60, 2000).astype(np.uint64))
        n = int(2000 * 2 * share / (1 + share))
        b = np.concatenate([a[:n], H.mix(rng.integers(1, 1 << 60, 2000 - n).astype(np.uint64))])
        low = near.min_hashes(np.concatenate([a, b]), np.array([0, 2000, 4000]))
        x, y = near.odd_sketches(low)
        differ = sum(bin(int(v) & (1 << 64) - 1).count("1") for v in x ^ y)
        assert abs(near.estimate(differ) - share) < 0.12 and differ <= near.sketch_limit(0.8)


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 8), (10, 11), (11, 12), (12, 13), (13, 14), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 1, 4: 4, 5: 4, 10: 10, 11: 10, 12: 10, 13: 10, 14: 10}


@pytest.mark.parametrize("digest", [substring.digest, linededup.digest, exact.digest, near.digest])
def test_empty_and_odd_tables(spark, digest):
    assert digest(docs(spark, [])).collect() == []
    ids = [None, 1, 1, *range(3, len(ODD))]
    assert len(digest(docs(spark, ODD, ids)).collect()) == len(ODD)
