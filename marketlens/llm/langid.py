"""Language identification by error-correcting output codes (operator 2).

Every language gets a codeword of bits; for each bit a binary classifier over
hashed character n-grams (1 to 3 letters, word boundaries included) tells the
languages whose bit is 1 from the others: a naive Bayes log-odds weight per
n-gram, averaged over the text.  Decoding is loss-weighted: the language whose
codeword has the least sum of logistic losses against all bit margins is
nearest; a small gap to the second nearest flags the text as ambiguous.

Training reads every labelled document, and every labelled language is learned.
Each task adds up its documents, so the counts, languages x 3 x ``GRAMS``
whatever the input size, are all that is shuffled; they become weights in Spark.
Weights and frequencies are integers, so equal texts get equal results in any
partitioning.

Null text or a text without a letter: ``und``, score 0, ambiguous.  No learned
language (empty or unlabelled training rows): ``und`` for all.  One learned
language: that one for every text with a letter, score 1.  Null id: kept as
null; not trained on.  Ties between languages: the first by name.  Rows that
repeat are predicted each; texts are read whole, in steps of a megabyte.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import map_slices, raw, real_id, stored, sum_slices, text_key, whole_id, whole_text

#: Hashed n-grams of each length.
GRAMS = 1 << 13
UNIT = 1_000_000
#: Loss gap between the two nearest codewords below which a text is ambiguous.
GAP = 1.0
#: A text's margins are weighed by its letters, up to this number: letters
#: beyond it make an average surer, but not without bound.
WEIGHT = 40.0
U = np.uint64


@cache
def _fold() -> np.ndarray:
    """Lower-cased code point of every letter, 0 for everything else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low[0])
    return out


def grams(text: bytes) -> np.ndarray:
    """Hashed n-grams of a text; empty without a letter."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    c = _fold()[points]
    keep = c != 0
    keep[1:] |= c[:-1] != 0  # a run of other characters is one boundary
    c = np.concatenate([[0], c[keep], [0]]).astype(U)
    if c.size < 3 or not keep.any():
        return np.zeros(0, np.int64)
    one = c[c != 0]
    two, three = c[:-1] * U(0x1FFFFF) + c[1:], (c[:-2] * U(0x1FFFFF) + c[1:-1]) * U(0x1FFFFF) + c[2:]
    mask = U(GRAMS - 1)
    return np.concatenate([(H.mix(x + U(n)) & mask) + U(n * GRAMS) for n, x in enumerate((one, two, three))]).astype(np.int64)


def gram_counts(text: bytes) -> np.ndarray | None:
    """Counts of all hashed n-grams of a text of any length."""
    total, lo = None, 0
    while lo < len(text):
        hi = min(len(text), lo + H.SPAN)
        while hi < len(text) and text[hi] not in b" \n":  # whole words
            hi += 1
        g = grams(text[lo:hi])
        if g.size:
            part = np.bincount(g, minlength=3 * GRAMS)
            total = part if total is None else total + part
        lo = hi
    return total


def _least_distance(code: np.ndarray) -> int:
    """Bits in which the two nearest codewords differ, in blocks of rows."""
    x, least = code.astype(np.float32), code.shape[1]
    for lo in range(0, x.shape[0], 1024):
        apart = (x.shape[1] - x[lo:lo + 1024] @ x.T) / 2
        apart[np.arange(apart.shape[0]), lo + np.arange(apart.shape[0])] = x.shape[1]
        least = min(least, int(apart.min()))
    return least


def codewords(k: int) -> np.ndarray:
    """(languages, bits) of +1 and -1: all splits for up to five languages,
    else the most spread of some random codes of 10 log2(k) bits."""
    if k <= 1:
        return np.ones((k, k), np.int64)
    if k <= 5:
        bits = range(1, 1 << (k - 1))
        return np.array([[1 if i == 0 or not b >> (i - 1) & 1 else -1 for b in bits] for i in range(k)])
    rng, best, spread = np.random.default_rng(7), None, -1
    size = int(np.ceil(10 * np.log2(k)))
    for _ in range(max(3, min(200, (1 << 26) // k**2))):  # fewer tries where one is long
        code = rng.choice([-1, 1], (k, size))
        if (np.abs(code.sum(0)) == k).any():
            continue
        if (least := _least_distance(code)) > spread:
            best, spread = code, least
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (3 * GRAMS, bits), in millionths


#: Languages that a task adds up at once.
HELD = 64


def counted(labelled: DataFrame) -> DataFrame:
    """(lang, gram, share) summed over all (id, lang, body) rows: at most
    languages x 3 x GRAMS rows, and as many from a task that holds no more than
    ``HELD`` languages."""
    def start():
        held = {}

        def emptied():
            grams = [np.flatnonzero(total) for total in held.values()]
            out = {"lang": [n for n, g in zip(held, grams, strict=True) for _ in range(g.size)],
                   "gram": np.concatenate(grams).astype(np.int32),
                   "share": np.concatenate([total[g] for total, g in zip(held.values(), grams, strict=True)])}
            held.clear()
            return out

        def rows(part):
            data, off = raw(part.column("body"))
            for name, a, b in zip(part.column("lang").to_pylist(), off[:-1], off[1:], strict=True):
                total = gram_counts(data[a:b].tobytes())
                if total is None:
                    continue
                if name not in held:
                    if len(held) == HELD:
                        yield emptied()
                    held[name] = np.zeros(3 * GRAMS, np.int64)
                g = np.flatnonzero(total)
                held[name][g] += shares(total, g)

        def rest():
            return emptied() if held else None

        return rows, rest

    found = sum_slices(labelled.select("lang", "body"), start, "lang string, gram int, share long")
    return found.groupBy("lang", "gram").agg(F.sum("share").alias("share"))


def shares(total: np.ndarray, g: np.ndarray) -> np.ndarray:
    """What a document adds to the counts of its n-grams: each weighs the same."""
    return total[g] * UNIT // int(total.sum())


def dense(table: pa.Table) -> tuple[list[str], np.ndarray]:
    """(languages by name, their counts of all n-grams) of a ``counted`` table."""
    names = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((len(names), 3 * GRAMS))
    at = {n: i for i, n in enumerate(names)}
    counts[[at[n] for n in table.column("lang").to_pylist()], table.column("gram").to_numpy()] = table.column("share").to_numpy()
    return names, counts


#: N-grams whose weights one step works out.
STEP = 64


def train(labelled: DataFrame) -> Model:
    """Fit on (id, lang, body) rows; see the module's bounds.  The driver gets
    one total for each language and the weights."""
    return train_counts(stored(counted(labelled), "language-counts"))


def train_counts(table: DataFrame) -> Model:
    """Fit on a stored table of ``counted``."""
    totals = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.sum("share").alias("n")).collect()}
    names = sorted(totals)
    code = codewords(len(names))
    weights = np.zeros((3 * GRAMS, code.shape[1]), np.int64)
    if len(names) > 1:
        shared = table.sparkSession.sparkContext.broadcast((names, np.array([float(totals[n]) for n in names]), code))

        def run(part: pa.Table) -> pa.Table:
            names, total, code = shared.value
            at, gram = {n: i for i, n in enumerate(names)}, part.column("gram").to_numpy()
            low = int(gram.min()) // STEP * STEP
            odds = np.zeros((len(names), STEP))
            odds[[at[n] for n in part.column("lang").to_pylist()], gram - low] = part.column("share").to_numpy()
            odds = odds / total[:, None] + 1e-6  # languages weigh the same
            w = np.stack([np.log(odds[c > 0].mean(0)) - np.log(odds[c < 0].mean(0)) for c in code.T], 1)
            return pa.table({"low": pa.array([low], pa.int32()), "weights": pa.array([np.round(w * UNIT).astype(np.int64).ravel()], pa.list_(pa.int64()))})

        steps = table.groupBy(F.expr(f"gram div {STEP}").alias("step")).applyInArrow(run, "low int, weights array<long>")
        for r in steps.toArrow().to_batches():
            for low, w in zip(r.column("low").to_pylist(), r.column("weights"), strict=True):
                weights[low:low + STEP] = w.values.to_numpy().reshape(STEP, -1)
    return Model(names, code, weights)


def margins(model: Model, text: bytes) -> tuple[np.ndarray, int] | None:
    """(average bit margins, letters) of a text with a letter."""
    total = gram_counts(text)
    return None if total is None else margins_of(model, total)


def margins_of(model: Model, total: np.ndarray) -> tuple[np.ndarray, int]:
    """The same from the counts of a text's n-grams."""
    g = np.flatnonzero(total)
    return total[g] @ model.weights[g] / (UNIT * float(total.sum())), int(total[:GRAMS].sum())


def decode(model: Model, margin: np.ndarray, letters: int) -> tuple[str, float, bool]:
    """(language, score, ambiguous): loss-weighted decoding.  The score is the
    nearest codeword's share of exp(-loss)."""
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    z = margin * min(float(letters), WEIGHT)
    loss = np.logaddexp(0, -model.code * z).sum(1)
    order = np.argsort(loss, kind="stable")
    first, second = loss[order[0]], loss[order[1]]
    share = np.exp(first - loss)
    return model.languages[order[0]], float(1 / share.sum()), bool(second - first < GAP)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, lang_pred, score, ambiguous, letters) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(part):
        m, out = shared.value, {"lang_pred": [], "score": [], "ambiguous": [], "letters": []}
        data, off = raw(part.column("body"))
        for a, b in zip(off[:-1], off[1:], strict=True):
            found = margins(m, data[a:b].tobytes()) if m.languages else None
            lang, score, unsure = decode(m, *found) if found else ("und", 0.0, True)
            for name, value in zip(out, (lang, score, unsure, found[1] if found else 0), strict=True):
                out[name].append(value)
        return {"id": part.column("id"), "text_key": part.column("text_key")} | out

    docs = df.select(whole_id(id_col), whole_text(text_col), text_key(text_col))
    return map_slices(docs, rows, "id long, text_key long, lang_pred string, score double, ambiguous boolean, letters long")


def held_out(id_col: str = "doc_id"):
    """Rows that the model never learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled(df: DataFrame) -> DataFrame:
    """(id, lang, body) of the rows that may be learned from."""
    rows = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    return rows.select(whole_id("doc_id"), "lang", whole_text("text"))


def learned(df: DataFrame) -> Model:
    return train(labelled(df))


#: Letters at which a text's own fit varies as much as the fits of texts do; from
#: there a language's limit holds as it is.
SURE = 200
#: Log-likelihood per n-gram that a text may fall short of its language's median.
SLACK = 1.25
#: Learned languages that may share a text.
NEAREST = 4
#: Steps a unit of fit that documents are counted by: quantiles come from a table
#: whose size is that of the range of fits, however many documents there are.
STEPS = 10_000


@dataclass(frozen=True)
class Known:
    languages: list[str]
    logs: np.ndarray  # (languages, 3 * GRAMS) log-likelihoods, in millionths
    medians: np.ndarray  # median fit of each language's documents
    limits: np.ndarray  # least fit of a long text of each language

    def accepts(self, lang: int, value: float, letters: int) -> bool:
        """Whether a text of a language may fit so badly: a mean over few letters
        varies more, so the shortfall allowed grows as the standard deviation."""
        wider = np.sqrt((1 + SURE / min(letters, SURE)) / 2)
        allowed = (self.medians[lang] - self.limits[lang]) * wider
        return not value < self.medians[lang] - allowed


def log_shares(share: np.ndarray) -> np.ndarray:
    return np.round(np.log(share + 1e-6) * UNIT).astype(np.int32)


def fit(logs: np.ndarray, n: np.ndarray) -> tuple[int, float]:
    """(nearest language, log-likelihood per n-gram) of a text with ``n`` of
    each n-gram; logs are the languages' for these n-grams.  Every n-gram may
    come from any of the ``NEAREST`` nearest languages, so a text of several
    fits like a text of one."""
    near = np.argsort(-(logs @ n), kind="stable")[:NEAREST]
    return int(near[0]), float(logs[near].max(0) @ n) / (UNIT * float(n.sum()))


def learned_and_known(df: DataFrame) -> tuple[Model, Known]:
    """Both models of a table from one count of its labelled documents."""
    table = stored(counted(labelled(df)), "language-counts")
    return train_counts(table), known(df, table)


def known(df: DataFrame, table: DataFrame | None = None) -> Known:
    """Absolute fit of the learned languages: unlike the score, a share among
    them, it tells a text that is in none of them however few they are.  A
    language's limit is ``SLACK`` below the median fit of all its labelled
    documents, or their 5% quantile if that is lower; each is measured without
    its own counts, so that few or varied documents give a low limit.  Fits are
    rounded to 1 / ``STEPS`` and counted, and the quantiles are those of the counts."""
    docs = labelled(df)
    names, counts = dense((counted(docs) if table is None else table).toArrow())
    totals = counts.sum(1)
    logs = log_shares(counts / totals[:, None])
    shared = df.sparkSession.sparkContext.broadcast((names, counts, totals, logs))

    def rows(part):
        names, counts, totals, logs = shared.value
        at, out = {n: i for i, n in enumerate(names)}, {"lang": [], "fit": []}
        data, off = raw(part.column("body"))
        for name, a, b in zip(part.column("lang").to_pylist(), off[:-1], off[1:], strict=True):
            total = gram_counts(data[a:b].tobytes())
            if total is None:
                continue
            g, i = np.flatnonzero(total), at[name]
            own, some = shares(total, g), logs[:, g]
            some[i] = log_shares((counts[i, g] - own) / max(1.0, totals[i] - own.sum()))
            out["lang"].append(name)
            out["fit"].append(round(fit(some, total[g])[1] * STEPS))
        return out

    fits = map_slices(docs.select("lang", "body"), rows, "lang string, fit int").groupBy("lang", "fit").agg(F.count(F.lit(1)).alias("n"))
    fits = fits.groupBy("lang").agg(F.expr("percentile(fit, array(0.05, 0.5), n)").alias("q"))
    found = {r["lang"]: [v / STEPS for v in r["q"]] for r in fits.collect()}  # a row a language
    return Known(names, logs, np.array([found[n][1] if n in found else 0.0 for n in names]),
                 np.array([min(found[n][0], found[n][1] - SLACK) if n in found else -np.inf for n in names]))


def accepted(df: DataFrame, model: Known, codes: Model | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that the language stage keeps: not
    those without a letter, nor those that fit the language that the codewords
    (``codes``; without them, the likelihood) tell worse than texts of their
    length may.  Without a learned language, every row with a letter stays.
    Nothing is shuffled."""
    shared = df.sparkSession.sparkContext.broadcast((model, codes))
    keyed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), whole_text(text_col))
    row = keyed.schema["row"].dataType.simpleString()

    def rows(part):
        (m, code), stays = shared.value, []
        at = {n: i for i, n in enumerate(m.languages)}
        data, off = raw(part.column("body"))
        for a, b in zip(off[:-1], off[1:], strict=True):
            total = gram_counts(data[a:b].tobytes())
            stay = total is not None
            if stay and m.languages:
                g = np.flatnonzero(total)
                near, value = fit(m.logs[:, g], total[g])
                if code is not None and code.languages:
                    near = at.get(decode(code, *margins_of(code, total))[0], near)
                stay = m.accepts(near, value, int(total[:GRAMS].sum()))
            stays.append(bool(stay))
        return {"row": part.column("row").filter(pa.array(stays))} if any(stays) else None

    return map_slices(keyed, rows, f"row {row}").select("row.*")


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op2."""
    out = predict(df, learned(df)).select(real_id("id").alias("doc_id"), "lang_pred", "score", "ambiguous")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
