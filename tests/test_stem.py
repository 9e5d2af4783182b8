import duckdb
import pytest
from pyspark.sql import functions as F

from textgauge.functions.stem import porter, rouge_stems, stem_tokens

# Word and stem pairs as published with the algorithm.
PUBLISHED = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "relational": "relat", "conditional": "condit", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ",
    "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "homologou": "homolog", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
}
# The usual extensions: short -ies and -ied, y after a vowel, irregular words, -logi, -fulli.
EXTENDED = {
    "ties": "tie", "dies": "die", "died": "die", "spied": "spi", "enjoy": "enjoy", "say": "say",
    "skies": "sky", "dying": "die", "news": "news", "geology": "geolog", "hopefully": "hope",
    "is": "is", "Running": "run",
}


@pytest.mark.parametrize("word,stem", [*PUBLISHED.items(), *EXTENDED.items()])
def test_porter(word, stem):
    assert porter(word) == stem


def test_stem_tokens_keep_rows_and_short_words(spark):
    rows = [(["running", "ties", "as", ""],), ([],), (None,), (["cats"],)]
    df = spark.createDataFrame(rows, "t array<string>")
    out = [tuple(r) for r in df.select(stem_tokens(F.col("t")), rouge_stems(F.col("t"))).collect()]
    assert out[0] == (["run", "tie", "as", ""], ["run", "tie", "as", ""])
    assert out[1] == ([], [])
    assert out[3] == (["cat"], ["cat"])
    short = spark.createDataFrame([(["was", "cats"],)], "t array<string>")
    assert short.select(rouge_stems(F.col("t"))).first()[0] == ["was", "cat"]


def test_sql_stems_are_the_same(spark):
    """The step-by-step SQL and the Python steps agree on every word of the documents."""
    import re

    import stem_sql
    from conftest import DATA

    words = set()
    for row in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("text").collect():
        words.update(re.findall("[a-z0-9]+", row.text.lower()))
    words |= set("relational radicalli rationalli ponies ties agreed hopping hissing happy analogi roll".split())
    listed = ", ".join(f"('{w}')" for w in sorted(words))
    rows = duckdb.connect().execute(
        f"WITH words AS (SELECT w FROM (VALUES {listed}) v(w)), " + ", ".join(stem_sql.stems("words")) + " SELECT w, stem FROM stems"
    ).fetchall()
    assert len(rows) == len(words) and [(w, s) for w, s in rows if s != porter(w)] == []
