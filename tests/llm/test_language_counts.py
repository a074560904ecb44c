"""The language models come from every labelled document."""

import random

import numpy as np

from marketlens.llm import langid
from tests.llm.conftest import docs


def test_every_labelled_document_is_counted(spark, monkeypatch):
    monkeypatch.setattr(langid, "HELD", 2)  # tasks also give sums out in between
    rows = [(k, ("a", "b", "c")[k % 3 if k % 10 == 0 else 0], b"a") for k in range(2400)]
    table = langid.counted(spark.createDataFrame(rows, "id long, lang string, body binary"))
    got = {r.lang: r.n for r in table.groupBy("lang").agg({"share": "sum"}).withColumnRenamed("sum(share)", "n").collect()}
    assert got == {n: sum(r[1] == n for r in rows) * langid.UNIT for n in "abc"}
    assert table.count() <= 3 * 4


def test_limits_are_quantiles_of_all_labelled_documents(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "qx" * rng.randint(1, 9)]) for _ in range(rng.randint(2, 40))) for _ in range(900)]
    df = docs(spark, texts, lang="en")
    model = langid.known(df)
    learned = [r.body for r in langid.labelled(df).collect()]
    totals = [langid.gram_counts(bytes(t)) for t in learned]
    shares = [langid.shares(t, np.arange(t.size)) for t in totals]
    all_ = np.sum(shares, 0)
    fits = []
    for t, own in zip(totals, shares):
        g = np.flatnonzero(t)
        rest = all_ - own
        fits.append(langid.fit(langid.log_shares(rest[g] / rest.sum())[None, :], t[g])[1])
    low, mid = np.quantile(fits, [0.05, 0.5])
    assert len(learned) > 600 and abs(model.medians[0] - mid) < 2 / langid.STEPS
    assert abs(model.limits[0] - min(low, mid - langid.SLACK)) < 2 / langid.STEPS
