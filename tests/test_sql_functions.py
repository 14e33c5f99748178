"""SQL functions equal the DataFrame column functions."""

from pyspark.sql import functions as F

from valuescope.functions.scalars import shorten_term_col, slug, to_int
from valuescope.functions.sql import register_sql_functions
from valuescope.functions.text import treebank_tokens, word_tokens

SF = "/root/testdata/sf0.001"


def test_sql_functions_equal_column_functions(spark):
    register_sql_functions(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.createOrReplaceTempView("vs_docs")
    via_sql = spark.sql("SELECT doc_id, vs_treebank_tokens(text) AS tb, vs_word_tokens(text) AS w, "
                        "vs_slug(source) AS sl FROM vs_docs")
    via_df = docs.select("doc_id", treebank_tokens("text").alias("tb"), word_tokens("text").alias("w"),
                         slug("source").alias("sl"))
    assert via_sql.exceptAll(via_df).count() == 0 and via_df.exceptAll(via_sql).count() == 0


def test_sql_scalars(spark):
    register_sql_functions(spark)
    vals = ["12", " 12 ", "+7", "-3", "0012", "12.5", "1e3", "r-70049", "", None, "99999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    df.createOrReplaceTempView("vs_vals")
    got = [r[0] for r in spark.sql("SELECT vs_to_int(v) FROM vs_vals").collect()]
    want = [r[0] for r in df.select(to_int(F.col("v"))).collect()]
    assert got == want == [12, 12, 7, -3, 12, 0, 0, 0, 0, 0, 0]
    terms = spark.createDataFrame([("http://ns.adobe.com/xap/1.0/rights/X",), ("urn:x",)], "t string")
    terms.createOrReplaceTempView("vs_terms")
    assert [r[0] for r in spark.sql("SELECT vs_short_term(t) FROM vs_terms").collect()] == \
        [r[0] for r in terms.select(shorten_term_col("t")).collect()] == ["xmpRights:X", "urn:x"]


def test_sql_tf_index(spark):
    register_sql_functions(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.createOrReplaceTempView("vs_docs2")
    sql_tf = spark.sql("SELECT doc_id, token, count(*) AS count FROM "
                       "(SELECT doc_id, explode(toks) AS token FROM "
                       " (SELECT doc_id, vs_treebank_tokens(text) AS toks FROM vs_docs2 WHERE text <> '')) "
                       "GROUP BY doc_id, token")
    from valuescope.operators import tf
    lib_tf = tf.tf_index(docs, "doc_id", ["text"])
    assert sql_tf.exceptAll(lib_tf).count() == 0 and lib_tf.exceptAll(sql_tf).count() == 0


def test_sql_fingerprints_equal_column_functions(spark):
    from valuescope.functions.vectors import fingerprint64, fold8
    register_sql_functions(spark)
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    emb.createOrReplaceTempView("vs_emb")
    via_sql = spark.sql("SELECT vec_id, vs_fingerprint64(embedding) AS f, vs_fold8(embedding) AS g FROM vs_emb")
    via_df = emb.select("vec_id", fingerprint64("embedding").alias("f"), fold8("embedding").alias("g"))
    assert via_sql.exceptAll(via_df).count() == 0 and via_df.exceptAll(via_sql).count() == 0


def test_sql_tokens_look_stop_words_up(spark):
    # 180 stop words: a set, not a walk of the list for every token.
    register_sql_functions(spark)
    spark.createDataFrame([("It isn't \"so\", cannot be. they'll see...",), (None,)], "t string").createOrReplaceTempView("vs_one")
    got = spark.sql("SELECT vs_treebank_tokens(t) AS tb, vs_word_tokens(t) AS w FROM vs_one")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and plan.count("INSET") == 2
    assert got.collect()[0]["tb"] == ["It", "n't", "``", "''", ",", "be.", "'ll", "see", "..."]
    assert got.collect()[1]["tb"] is None
