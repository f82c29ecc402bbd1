"""The registered queries on the smallest driver tables, against their SQL."""

import duckdb
import pytest

import corpus_pipeline
from widegrain.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == sorted(cursor.fetchall())


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert corpus_pipeline.languages(spark, docs, sf_dir).columns == docs.columns
    assert corpus_pipeline.lines(spark, docs, sf_dir).columns == docs.columns
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = {r["doc_id"] for r in got.collect()}
    assert ids <= {r["doc_id"] for r in docs.collect()} and len(ids) > 0.7 * docs.count()


def _clashing(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, 2, 3, "b", 4) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score int, n_dropped int, "
                                 "mix_block int, text_hash string, n_tokens int")


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    long = " ".join(f"word{i} stands alone here" for i in range(20_000))
    rows = [(i, f"The {i} harvest of the valley number {i * 7} was counted by the old miller and his {i + 3} sons.\nA line that many share here.", "en", f"s{i % 3}", 5)
            for i in range(60)]
    rows += [(100, None, "en", "s", 1), (101, "", None, None, None), (102, long, "en", "s1", 9), rows[3], (None, "No id has this text at all.", "en", "s", 1),
             (103, rows[5][1], "en", "s2", 5)]
    docs = _clashing(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.schema.fieldNames() == docs.columns and got.dtypes == docs.dtypes, name
        seen = got.collect()
        assert {(r["score"], r["n_dropped"], r["mix_block"], r["text_hash"], r["n_tokens"]) for r in seen} <= {(1, 2, 3, "b", 4)}, name
        assert {r["doc_id"] for r in seen} <= {r[0] for r in rows} and len(seen) >= 50, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_line_stage_drops_what_it_empties(spark, sf_dir):
    a, b = "The first line of the text.", "The second line of the text."
    docs = spark.createDataFrame([(1, f"{a}\n{b}", "en", "s", 1), (2, f"{a}\n\n{b}", "en", "s", 1), (3, f"{b}\nown words", "en", "s", 1), (4, "", "en", "s", 0),
                                  (5, None, "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.lines(spark, docs, sf_dir).collect()}
    assert got == {1: (f"{a}\n{b}", 1), 3: ("own words", 9), 4: ("", 0), 5: ("", None)}


def test_no_copy_that_the_operator_finds_passes_its_stage(spark, sf_dir):
    from widegrain.llm import near_duplicates
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = near_duplicates.near_duplicates(docs.select("doc_id", "text"), width=5, share=80).collect()
    kept = {r["doc_id"] for r in told if r["kept"]}
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, sf_dir).collect()} == kept and len(kept) < len(told)
