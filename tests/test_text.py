import random
import re
import string

from pyspark.sql import functions as F

from textgauge.functions import prompts as pr
from textgauge.functions import text as tx

TEXTS = [
    "", "   ", " a  b ", "One, two; THREE!", "tab\tnew\nline\r\nend", "no break em",
    "Élan «quoted» naïve", "x\x1cy\x85z", "don't (stop)", "a_b-c/d\\e", "ß straße", "　ideo　",
]


def one(spark, texts, **columns):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r.asDict() for r in df.select("text", *[c.alias(n) for n, c in columns.items()]).collect()]


def test_tokens_match_python(spark):
    text = F.col("text")
    rows = one(
        spark, TEXTS,
        words=tx.whitespace_tokens(text), clean=tx.normalise(text), alnum=tx.alnum_tokens(text),
    )
    drop = str.maketrans("", "", string.punctuation)
    for row in rows:
        assert row["words"] == row["text"].split()
        assert row["clean"] == row["text"].lower().translate(drop)
        assert row["alnum"] == re.findall("[a-z0-9]+", row["text"].lower())


def test_word_tokens_cut_quotes_and_contractions(spark):
    text = "i cannot say «hi» don’t gonna wannabe Gimme cannots"
    got = one(spark, [text, ""], out=tx.word_tokens(F.col("text")))
    assert got[0]["out"] == (
        "i can not say « hi » don ’ t gon na wannabe Gim me cannots".split()
    )
    assert got[1]["out"] == []


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    rows = [r[0] for r in df.select(F.expr(tx.ngrams("t", 2))).collect()]
    assert rows == [["a b", "b c"], [], []]
    assert [r[0] for r in df.select(F.expr(tx.ngrams("t", 3))).collect()] == [["a b c"], [], []]


def test_page_text(spark):
    html = (
        "<html><style>p{}</style><SCRIPT>var t='</p>';</SCRIPT><!-- <b>no</b> --><p>A &amp;lt; B"
        " &copy; c</p>\n\n<b>d</b></html>"
    )
    assert one(spark, [html], out=tx.page_text(F.col("text")))[0]["out"] == "A &lt; B © c d"


def test_completion_text(spark):
    raw = "<|user|><|image_1|>Say it.<|end|><|assistant|>A dog.<|end|>"
    assert one(spark, [raw, "plain"], out=tx.completion_text(F.col("text")))[0]["out"] == "A dog."


def test_prompts_and_names(spark):
    text = F.col("text")
    row = one(
        spark, ["a/b/pic.final.jpg"],
        base=pr.base_name(text), out=pr.output_name(F.lit("res"), text, "_styled.png"),
        chat=pr.chat_prompt(F.lit("Do.")), style=pr.style_prompt(F.lit("cap")),
        grounded=pr.grounded_prompt(F.lit("CTX"), F.lit("Q?")),
    )[0]
    assert row["base"] == "pic.final.jpg"
    assert row["out"] == "res/pic.final_styled.png"
    assert row["chat"] == "<|user|><|image_1|>Do.<|end|><|assistant|>"
    assert row["style"].endswith(":\n\ncap")
    assert row["grounded"].endswith("Context: CTX\nHuman: Q?") and "{context}" not in row["grounded"]


def test_numbered_name_keeps_long_numbers(spark):
    df = spark.createDataFrame([(7,), (12345678,)], "n bigint")
    assert [r[0] for r in df.select(pr.numbered_name(F.col("n"))).collect()] == [
        "000007.jpg", "12345678.jpg",
    ]


def test_four_decimals(spark):
    rng = random.Random(2)
    values = [0.32371, 1234.5, 0.0, 1.0, 0.15625, 0.03125, 0.00625, 0.12345, 0.00005, 0.99995]
    values += [rng.random() for _ in range(300)] + [rng.randint(0, 99_999) / 1e5 for _ in range(600)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(tx.four_decimals("x")).collect()] == [f"{v:.4f}" for v in values]
