"""The queries themselves on small tables, against brute force, round trips or their SQL in DuckDB."""

import hashlib
import re
import struct
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from loomspan.llm import registry, toxicity

from test_corpus_ops import brute_near, brute_repeats, corpus
from test_text_ops import ODD, PII, base_spans

HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
WORDS = " ".join(f"w{i}" for i in range(60))


def texts():
    long = " ".join(f"long{i % 977}" for i in range(30_000))  # beyond a pass of some operators
    return [*ODD[:-2], *PII[:10], *corpus(4), f'a token = "{HEX}" b', WORDS, WORDS + " you idiot scum moron", WORDS + " #$%&" * 40, "the benchmark says: alpha beta gamma delta " + WORDS, long, long + " end"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables with nulls, empty and long texts, repeats, and columns that operators do not expect."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = [(i * 3, t, ("en", "de", None)[i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts())]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i * 3, 1, int("idiot" in (t or ""))) for i, t in enumerate(texts())], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("i1", WORDS), ("i2", "alpha beta gamma delta"), ("i3", None), (None, "")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    chats = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 0, None, None), (2, 1, "tool", "[/ROLE] <\\s>"), (3, 0, "system", "x")]
    spark.createDataFrame(chats, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


def run(spark, tables, name):
    return sorted((r.asDict() for r in registry.QUERIES[name](spark, tables).collect()), key=lambda r: next(iter(r.values())))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    got = registry.QUERIES[name](spark, tables)
    rows = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in rows.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(repr(tuple(r[names.index(c)] for c in got.columns)) for r in rows.fetchall())
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_every_query_has_sql_or_a_test():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL) | (set(registry.TESTS) - {"pipeline"})


def test_op1(spark, tables):
    import public_tokenizers
    import tiktoken

    from loomspan.llm import bpe

    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.rank_file()), special_tokens={})
    for r, t in zip(run(spark, tables, "op1_byte_bpe"), texts(), strict=True):
        ids = reference.encode_ordinary(t or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_op2(spark, tables):
    rows = run(spark, tables, "op2_toxicity")
    assert len(rows) == len(texts()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert [r["predicted"] for r, t in zip(rows, texts()) if "idiot" in (t or "")] == [1] and sum(r["predicted"] for r in rows) == 1


def test_op2_held_out_accuracy(spark, tmp_path):
    from test_toxicity import made

    docs, labels = made(1500, 5)
    spark.createDataFrame([(i, t) for i, t, *_ in docs], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = toxicity.op2_toxicity(spark, str(tmp_path)).where("held_out").collect()
    truth = dict(labels)
    assert len(rows) > 300 and sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows) > 0.97


def test_op3(spark, tables):
    for r, t in zip(run(spark, tables, "op3_pii"), texts(), strict=True):
        want = base_spans(t or "")
        kinds = [x.split(":")[0] for x in want.split(",")]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]


def test_op6(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    start = 0
    for r, t in zip(run(spark, tables, "op6_token_file"), texts(), strict=True):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_op7(spark, tables):
    rows = run(spark, tables, "op7_suffix_array_dedup")
    small = [t if len(t or "") < 100_000 else None for t in texts()]
    want = brute_repeats(small)
    for r, w, t in zip(rows, want, small, strict=True):
        if t is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == w[1:]
    assert rows[-1]["n_removed"] >= len("long") * 30_000  # the last two texts share all but their ends


def test_op8(spark, tables):
    got = [(r["doc_id"] // 3, r["n_shingles"], r["component_id"] // 3) for r in run(spark, tables, "op8_minhash_near_dedup")]
    assert got == brute_near(texts())


def test_op9(spark, tables):
    from loomspan.llm import secret_scan

    rows = run(spark, tables, "op9_secret_scan")
    for r, t in zip(rows, texts(), strict=True):
        out, at = "", 0
        for kind, a, b in (x.split(":") for x in r["spans"].split(",") if x):
            out, at = out + (t or "")[at : int(a)] + f"[SECRET:{kind.upper()}]", int(b)
        assert r["redacted_sha256"] == hashlib.sha256((out + (t or "")[at:]).encode()).hexdigest()
        assert r["n_secrets"] == len([x for x in r["spans"].split(",") if x]) <= r["n_candidates"] == len(re.findall(secret_scan.CANDIDATE, t or ""))
    assert [r["spans"] for r, t in zip(rows, texts()) if HEX in (t or "")] == ["secret:11:51"]


def test_empty_tables(spark, tables, tmp_path):
    for t in ("documents", "labels", "benchmark", "conversations"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in registry.QUERIES.items():
        rows = query(spark, str(tmp_path)).collect()
        assert len(rows) == (name == "op4_chat_format"), name  # conversation -1 is always there


def test_a_column_of_any_name_is_kept(spark):
    from loomspan.llm import bpe, decontaminate, pii, secret_scan

    names = ["pii", "_row", "ids", "text", "hits", "n_words", "found", "secrets", "score", "node"]
    docs = spark.createDataFrame([tuple("x" for _ in names)], ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([("i", "x")], "item_id string, text string")
    for rows in (pii.find(docs), bpe.encode(docs), decontaminate.search(docs, bench), secret_scan.scan(docs, secret_scan.default_forest(spark)), toxicity.score(docs, toxicity.seed_model())):
        (r,) = rows.select(F.col("_row")).collect()
        assert list(r["_row"].asDict()) == names and set(r["_row"]) == {"x"}
