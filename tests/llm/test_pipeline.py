"""The pipeline's stages on made documents against plain Python."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from loomspan.llm import decontaminate

HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def made(tmp):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = text(30)
    docs, toxic = {}, {}
    for i in range(400):
        docs[i], toxic[i] = text(rng.randrange(40, 120)), 0
        if i % 5 == 0:
            w = docs[i].split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zorquen", "zorqua", "grumly"]))
            docs[i], toxic[i] = " ".join(w), 1
    docs[1001] = docs[1]
    w = docs[2].split()
    docs[1002] = " ".join(w[:-1] + ["other"])
    docs[1003] = text(20) + " " + item + " " + text(20)
    docs[1004] = text(50) + f' token = "{HEX}" ' + text(5)
    docs[1005], docs[1006], docs[1007] = None, "", "  "
    return docs, toxic, item


def tables(spark, tmp_path):
    docs, toxic, item = made(tmp_path)
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i1", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs, toxic, item


def test_run(spark, tmp_path):
    docs, toxic, item = tables(spark, tmp_path)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    gone = {i for i, t in toxic.items() if t} | {1001, 1002, 1003}
    assert sorted(got) == sorted(set(docs) - gone)
    assert got[1005]["n_tokens"] == got[1006]["n_tokens"] == 0 and got[1]["n_tokens"] == len(got[1]["ids"])


def test_each_stage_keeps_the_columns_and_clean_rows(spark, tmp_path):
    docs, toxic, item = tables(spark, tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {n: f(spark, rows, str(tmp_path)) for n, f in corpus_pipeline.STAGES}
    for n, df in list(left.items())[:-1]:
        assert df.columns == rows.columns and df.dtypes == rows.dtypes, n
    marked = {r["doc_id"]: r for r in left["secrets"].collect()}
    for i, t in docs.items():
        want = t.replace(HEX, "[SECRET:SECRET]") if t else t
        assert marked[i]["text"] == want and marked[i]["n_chars"] == len(want or "")
    assert {r[0] for r in left["decontamination"].select("doc_id").collect()} == set(docs) - {1003}
    words = {i: (t or "").split() for i, t in docs.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in words.items()}
    low = {i: min([i, *(j for j in docs if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))]) for i in docs}
    assert {r[0] for r in left["near_dedup"].select("doc_id").collect()} == {i for i in docs if low[i] == i}
    kept = {r[0] for r in left["toxicity"].select("doc_id").collect()}
    assert kept == {i for i in docs if not toxic.get(i)}


def test_empty_tables_and_repeated_rows(spark, tmp_path):
    tables(spark, tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, rows.limit(0), str(tmp_path)).count() == 0, name
    some = rows.where("doc_id in (1, 2)")
    twice = some.unionByName(some).unionByName(some.withColumn("doc_id", F.lit(None).cast("long")))
    got = corpus_pipeline.drop_near_duplicates(spark, twice, str(tmp_path))
    assert sorted((r["doc_id"] or -1) for r in got.collect()) == [-1, -1, 1, 2]
    assert decontaminate.words_of(None) == []


def test_texts_that_share_a_doc_id(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(1, text(0)), (3, text(1)), (3, text(2)), (3, text(2)), (3, text(3).upper()), (4, text(3)), (5, text(0)), (5, text(4)), (5, text(4).replace(" ", "  ")), (None, text(0)), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    got = sorted(((r["doc_id"] or 0), " ".join((r["text"] or "").split())) for r in left.collect())
    assert got == sorted([(0, ""), (0, text(0)), (1, text(0)), (3, text(1)), (3, text(2)), (3, text(3).upper()), (5, text(4))])
