from pyspark.sql import functions as F

from shelfstream.functions import text


def values(spark, data, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v string")
    return [r["out"] for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_csv_protect_trims_and_quotes_only_where_needed(spark):
    got = values(spark, ['a"b', "abc/", "abc /", "tail  ", "plain1", None, "a,b", "//"], text.csv_protect)
    assert got == ['"a""b"', "abc", "abc", "tail", "plain1", "", '"a,b"', '"/"']


def test_csv_protect_without_trim_keeps_slash_and_blanks(spark):
    got = values(spark, ["abc/", "x ", 'q"'], lambda v: text.csv_protect(v, trim=False))
    assert got == ['"abc/"', '"x "', '"q"""']


def test_csv_line_keeps_empty_cells(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(text.csv_line([F.col(c) for c in "abc"])).first()[0] == "a,,c"


def test_hash_quote(spark):
    assert values(spark, ["x", "", None], text.hash_quote) == ["##x##", "", ""]


def test_attempt_year(spark):
    assert values(spark, ["c1999, 2001", None, "no digits", "[19]"], text.attempt_year) == ["1999", None, "", "19"]


def test_attempt_price(spark):
    got = values(spark, ["$12.345 pbk", "1.2.3", "9999999", "", None, "£5", ".5", "."], text.attempt_price)
    assert got == ["1235", "", "", "", None, "500", "50", ""]


def test_norm_isbn(spark):
    data = ["0-306-40615-2", "9780306406157", "080442957X", "junk", " 978 0306 406157 pbk", "0000000000000", None, "030640615"]
    assert values(spark, data, text.norm_isbn) == [
        "9780306406157", "9780306406157", "9780804429573", None, "9780306406157", None, None, None,
    ]


def test_extract_isbns_is_distinct_and_ordered(spark):
    joined = "080442957x;0-306-40615-2;junk;9780306406157"
    assert values(spark, [joined, None, "junk"], text.extract_isbns) == ["9780804429573;9780306406157", "", ""]


def test_isbn_token(spark):
    assert values(spark, [" 0306406152 (pbk.)", "123:sewn", "(x)", "9.95"], text.isbn_token) == ["0306406152", "123", "", "9"]


def test_naco_normalize(spark):
    got = values(spark, ["Éd. Révisée (2)", "O'Brien [ed.]", "  A--B  ", "Re\u0301vise\u0301e"], text.naco_normalize)
    assert got == ["ed revisee 2", "obrien ed", "a b", "revisee"]


def test_naco_folds_composed_letters(spark):
    rows = [("Tiếng Việt", "tieng viet"), ("Ǻngström's [ø] Łódź đ", "angstroms o lodz d"), ("Ελλάδα", "ελλαδα"), ("e\u0301té", "ete"),
            ("한국", "한국"), ("ß-x", "ß x"), ("", ""), ("ﬁ ½", "ﬁ ½")]
    got = spark.createDataFrame(rows, "v string, expected string").select(text.naco_normalize(F.col("v")).alias("n"), "expected").collect()
    assert [r.n for r in got] == [r.expected for r in got]
    composed, plain = text.folds()
    assert len(composed) == len(plain) > 800 and len(set(composed)) == len(composed)
