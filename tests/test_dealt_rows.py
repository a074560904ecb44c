"""Costly work on each row is shared out, however few tasks read the rows."""

from marketlens.operators import typing as TY
from marketlens.sources.fixtures import reviews_df
from marketlens.sources.tables import Tables


def test_scraped_rows_are_typed_by_all_tasks(spark):
    raw = spark.createDataFrame([("d", 1, [" a.b\nmore ", "\t$1.5K\n2", "12,000", None]), ("d", 2, ["", "http://x.example/p \nq", "3"]), ("d", 3, ["x"]),
                                 ("e", 1, [None, " 7 "]), (None, None, ["\n word", "N/A", "-", "45%", "1.2M"])],
                                "domain string, row_seq long, cells array<string>").coalesce(1)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert TY.link_rows(raw).rdd.getNumPartitions() == TY.keyword_rows(raw).rdd.getNumPartitions() == tasks
    got = sorted((str(r.domain), r.row_seq, r.table, r.item, r.referring_domains, r.backlinks) for r in TY.link_rows(raw).collect())
    assert got == sorted([("d", 1, "anchors", "a.b", 1500.0, 12000.0), ("d", 1, "referring_domains", "$1.5K", 0.0, 0.0), ("d", 2, "anchors", "http://x.example/p", 3.0, 0.0),
                          ("d", 2, "referring_domains", "http://x.example/p", 0.0, 0.0), ("d", 2, "top_pages", "http://x.example/p ", 3.0, 0.0),
                          ("e", 1, "anchors", "7", 7.0, 0.0), ("None", None, "anchors", "word", 45.0, 1200000.0),
                          ("None", None, "top_pages", "N/A", 45.0, 1200000.0)])


def test_reviews_are_prepared_by_all_tasks(spark, tmp_path):
    spark.createDataFrame([(k, f"text {k}", "en", "s", 6) for k in range(40)] + [(None, None, None, None, None)],
                          "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []

    def prepare(docs):
        seen.append(docs.rdd.getNumPartitions())
        return docs

    got = reviews_df(Tables(spark, str(tmp_path)), prepare)
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    rows = {r.review_seq: (r.text, r.rating) for r in got.collect()}
    assert rows == {None: (None, None)} | {k: (f"text {k}", {3: 2, 4: 5}.get(k)) for k in range(40)}
