from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators import cleaning


def pairs(spark, rows):
    return spark.createDataFrame(rows, "line_no bigint, src string, tgt string")


def test_strip_takes_unicode_whitespace(spark):
    rows = ["\t a b \n", " x　", " \t\r\n", "", "\x1cq\x85", "no change"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    assert [r[0] for r in df.select(tx.strip("t")).collect()] == [r.strip() for r in rows]
    assert [r[0] for r in df.select(tx.words("t")).collect()] == [r.split() for r in rows]


def test_drop_empty_pairs(spark):
    df = pairs(spark, [(1, "", ""), (2, "a", ""), (3, "", "b"), (4, " \t", "b"), (5, " a|b ", "c\td"), (6, " ", "x")])
    kept = cleaning.drop_empty_pairs(df).collect()
    assert [(r.line_no, r.src, r.tgt) for r in kept] == [(5, "a|b", "c\td")]
    assert [r.line_no for r in cleaning.drop_empty_pairs(df, strip=False).collect()] == [4, 5, 6]


def test_filter_by_score_is_strict_and_drops_missing(spark):
    df = spark.createDataFrame(
        [(1, 0.5), (2, 0.5000001), (3, None), (4, float("nan")), (5, 1.0), (6, 0.0)], "line_no bigint, score double"
    )
    assert [r.line_no for r in cleaning.filter_by_score(df, 0.5).collect()] == [2, 5]


def test_length_filter_is_all_or_nothing_and_counts(spark):
    df = spark.createDataFrame(
        [([], ["a"]), (["a"], ["a"]), (["a"] * 3, ["b"] * 2), (["a"] * 9, ["b"] * 2), ([], [])],
        "src_pieces array<string>, tgt_pieces array<string>",
    )
    assert cleaning.length_filter(df, 2, 5).count() == 1
    stats = cleaning.encode_stats(df, 2, 5).first().asDict()
    # Sides: three are empty, three too short (2 x "a" pair, 1 beside an empty side), one too long.
    assert stats == {"num_lines": 5, "num_empty": 3, "num_filtered": 4, "num_kept": 1}


def test_parse_hypotheses(spark):
    log = ["S-2\tsrc", "H-10\t-0.5\tten", "H-2\t-1.25\ttab\there", "D-2\t-1\tno", "H-3\t-0.1\t", "P-1\t-0.1", "H-x\tnan?\tq"]
    df = spark.createDataFrame([(x,) for x in log], "line string")
    last = {r.sent_id: (r.score, r.text) for r in cleaning.parse_hypotheses(df).collect()}
    assert last == {10: (-0.5, "ten"), 2: (-1.25, "here"), 3: (-0.1, ""), None: (None, "q")}
    third = {r.sent_id: r.text for r in cleaning.parse_hypotheses(df, field="third").collect()}
    assert third[2] == "tab"


def test_codes_labels_and_subwords(spark):
    df = spark.createDataFrame([("en_XX", "07", "▁He llo ▁wor ld")], "tag string, label string, pieces string")
    row = df.select(
        tx.lang_code("tag"), tx.lang_symbol("tag"), tx.score_label("label"), tx.remove_subwords("pieces"),
        tx.join_pieces(F.split("pieces", " ")),
    ).first()
    assert tuple(row) == ("en", "__en_XX__", 0.7, "Hello world", "Hello world")


def test_tags_and_placeholder(spark):
    df = spark.createDataFrame([(3, ["a"], ["b"])], "line_no bigint, src_pieces array<string>, tgt_pieces array<string>")
    row = cleaning.add_lang_tags(df, "en_XX", "de_DE").first()
    assert (row.src_pieces, row.tgt_pieces) == (["en_XX", "a"], ["de_DE", "b"])
    assert cleaning.with_placeholder(df).first().tgt == "3"


def test_parse_report(spark):
    df = spark.createDataFrame([("BLEU = 23.45 60.1/",), ("chrF2 = n/a",), ("x",)], "line string")
    assert [r.value for r in cleaning.parse_report(df).collect()] == [23.45, None, None]
