"""Tokenisers, notes and term frequencies on literal fixtures."""

from pyspark.sql import functions as F

from valuescope.functions.text import STOP_WORDS_EN, treebank_tokens, word_tokens
from valuescope.operators import tf

LIT1 = "The quickish brown fox'es jumped over the lazy-dog."
LIT2 = "a-uuid-with-dashes Some isn't \"99\", nor is it good; only bad. 3kas9203h: CAT32423432"


def _tokens(spark, fn, text):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("x")).first()["x"]


def test_stop_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(STOP_WORDS_EN) == StopWordsRemover.loadDefaultStopWords("english")


def test_treebank_literals(spark):
    assert _tokens(spark, treebank_tokens, LIT1) == \
        "The quickish brown fox'es jumped lazy-dog .".split()
    assert _tokens(spark, treebank_tokens, LIT2) == \
        "a-uuid-with-dashes Some n't `` 99 '' , good ; bad. 3kas9203h : CAT32423432".split()


def test_word_literals(spark):
    assert _tokens(spark, word_tokens, LIT1) == "quickish brown fox es jumped lazy dog".split()
    assert _tokens(spark, word_tokens, LIT2) == \
        "uuid dashes isn 99 good bad 3kas9203h cat32423432".split()


def test_treebank_rules(spark):
    cases = {
        '"Hello," she said.': ["``", "Hello", ",", "''", "she", "said", "."],
        "I cannot gonna (x) --y": ["I", "can", "not", "gon", "na", "(", "x", ")", "--", "y"],
        "He's done... ok?": ["He", "'s", "done", "...", "ok", "?"],
        "12,000 items: a,b": ["12,000", "items", ":", "a", ",", "b"],
    }
    for text, expected in cases.items():
        assert _tokens(spark, lambda c, s=None: treebank_tokens(c, []), text) == expected, text


def test_repeated_tokens_keep_counts(spark):
    df = spark.createDataFrame([(1, "b b a")], "id int, t string")
    rows = {r["token"]: r["count"] for r in tf.tf_index(df, "id", ["t"], tokenizer="words").collect()}
    assert rows == {"b": 2}


def test_notes_null_and_empty(spark):
    df = spark.createDataFrame([(1, None, "a", ""), (2, None, None, None), (3, "", "", None)],
                               "id int, x string, y string, z string")
    n = {r["id"]: r["note"] for r in tf.notes(df, "id", ["x", "y", "z"]).collect()}
    assert n == {1: "a ", 3: " "}
    index = tf.tf_index(df, "id", ["x", "y", "z"], tokenizer="treebank", stop_words=[])
    assert {(r["id"], r["token"]) for r in index.collect()} == {(1, "a")}


def test_stepwise_equals_one_line(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = tf.tf_index(docs, "doc_id", ["text"])
    toks = tf.tokens(docs, "doc_id", ["text"])
    step = toks.groupBy("doc_id", "token").count()
    assert one.exceptAll(step).count() == 0 and step.exceptAll(one).count() == 0


def test_whitespace_class_is_python_isspace():
    import regex
    from valuescope.functions.text import WS
    pattern = regex.compile(WS.replace("\\x{1c}", "\\x1c").replace("\\x{20}", "\\x20").replace("\\x{85}", "\\x85"))
    ours = {c for c in range(0x10000) if pattern.fullmatch(chr(c))}
    python = {c for c in range(0x10000) if chr(c).isspace()}
    assert ours == python


def test_unicode_spaces_and_digits(spark):
    text = "a b,٣c end.　"
    assert _tokens(spark, lambda c, s=None: treebank_tokens(c, []), text) == ["a", "b,٣c", "end", "."]


def test_treebank_published_examples(spark):
    # Outputs published in the documentation of the reference Treebank tokenizer.
    tok = lambda c, s=None: treebank_tokens(c, [])
    text = "Good muffins cost $3.88\nin New York.  Please buy me\ntwo of them.\nThanks."
    assert _tokens(spark, tok, text) == ["Good", "muffins", "cost", "$", "3.88", "in", "New", "York.",
                                         "Please", "buy", "me", "two", "of", "them.", "Thanks", "."]
    assert _tokens(spark, tok, "They'll save and invest more.") == \
        ["They", "'ll", "save", "and", "invest", "more", "."]
    assert _tokens(spark, tok, "hi, my name can't hello,") == \
        ["hi", ",", "my", "name", "ca", "n't", "hello", ","]


def test_contraction_boundaries_unicode_and_adjacent(spark):
    tok = lambda c, s=None: treebank_tokens(c, [])
    assert _tokens(spark, tok, "cannot٣") == ["cannot٣"]            # ٣ is a word character
    assert _tokens(spark, tok, "écannot") == ["écannot"]
    assert _tokens(spark, tok, "cannot-cannot cannot") == ["can", "not", "-", "can", "not", "can", "not"]
    assert _tokens(spark, tok, "'Tis 'twas gonna") == ["'T", "is", "'t", "was", "gon", "na"]
    assert _tokens(spark, tok, "Cannot CANNOT") == ["Can", "not", "CAN", "NOT"]
    assert _tokens(spark, tok, "it's 'tis 'tis") == ["it", "'s", "'t", "is", "'t", "is"]


def test_treebank_text_equals_the_rules_one_by_one(spark):
    # The guarded and rewritten steps give the very texts of the plain rule chain.
    import random

    from valuescope.functions.text import java_replacement, treebank_steps, treebank_text
    rng = random.Random(5)
    parts = ["a", "n", "N", "'", "''", '"', "``", " ", "  ", "\n", ".", "...", "..", ",", ":", "!", "?", ")", "(", "[", "]",
             "{", ">", "--", "-", "'s", "'S ", "'ll ", "n't ", "N'T ", "'ve", "cannot", "CANNOT", "d'ye", "gimme", "Gonna",
             "gotta", "lemme", "more'n", "more'n'tis", "wanna ", " 'tis", " 'Twas", "é", "\u212a", "\u3000", "\x85", "7", "$", "&",
             "\U0001f600", ";", "x"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(6000)]
    texts += [None, "", "don't'll ", "it's 's ", "'''s '", "x'll 'll ", "a.)\"' \n", "a..", ".", "a:\n", ",\n", "more'n'tis"]
    plain = F.col("t")
    for pattern, repl in treebank_steps():
        plain = (F.concat(F.lit(" "), plain, F.lit(" ")) if pattern == "PAD"
                 else F.regexp_replace(plain, F.lit(pattern), F.lit(java_replacement(repl))))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", treebank_text("t").alias("got"), plain.alias("want")).collect()
    assert [r for r in rows if r["got"] != r["want"]] == []


def test_texts_without_quotes_meet_no_quote_rule(spark):
    # A substring test stands before every rule that needs a quote or a contraction.
    from valuescope.functions.text import spark_steps
    rewrites, contractions = spark_steps()
    bare = [s for s in rewrites if s[0] == "regex" and not s[3] and not s[4]]
    assert [s[1][:9] for s in bare] == ["([:,])([^", "\\.(?<=[^."]
    assert all(needle for needle, _ in contractions) and len(contractions) == 10
