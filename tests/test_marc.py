from pyspark.sql import functions as F

from shelfstream.functions import marc
from shelfstream.functions.text import naco_normalize

BODY = (
    '<leader>x</leader><datafield tag="020"><subfield code="a">1</subfield></datafield>'
    '<datafield tag="020"><subfield code="c">$5</subfield></datafield>'
    '<datafield tag="245"><subfield code="a">Main &amp; title</subfield><subfield code="p">Part</subfield></datafield>'
    '<datafield tag="650"><subfield code="a">One</subfield></datafield>'
    '<datafield tag="650"><subfield code="a">Two</subfield></datafield>'
)


def parsed(spark, *records):
    df = spark.createDataFrame(list(enumerate(records)), "i int, m string")
    return df.select("i", marc.parse_marc(F.col("m")).alias("fields"))


def test_default_and_prefixed_namespaces_read_alike(spark):
    plain = f'<record xmlns="http://www.loc.gov/MARC21/slim">{BODY}</record>'
    prefixed = BODY
    for name in ("leader", "datafield", "subfield"):
        prefixed = prefixed.replace(f"<{name}", f"<marc:{name}").replace(f"</{name}", f"</marc:{name}")
    prefixed = f'<marc:record xmlns:marc="http://www.loc.gov/MARC21/slim">{prefixed}</marc:record>'
    got = parsed(spark, plain, prefixed).select(
        marc.marc_title(F.col("fields")).alias("t"),
        marc.first_value(F.col("fields"), ("020",), "c").alias("any_c"),
        marc.first_field_value(F.col("fields"), "020", "c").alias("first_c"),
        marc.subject_string(F.col("fields"), "650", naco_normalize).alias("s"),
    ).collect()
    assert [tuple(r) for r in got] == [("Main & title Part", "$5", None, "!!!one!!!two!!!")] * 2


def test_malformed_and_null_records_give_no_fields(spark):
    got = parsed(spark, "<record><datafield", None, "", "<record><leader>x</leader></record>").select(
        marc.first_value(F.col("fields"), ("245",), "a").alias("a"),
        marc.subject_string(F.col("fields"), "650", naco_normalize).alias("s"),
        marc.marc_title(F.col("fields")).alias("t"),
    ).collect()
    assert [tuple(r) for r in got] == [(None, None, "")] * 4


def test_subject_string_is_cut_to_200(spark):
    long = "".join(f'<datafield tag="650"><subfield code="a">{"x" * 90}</subfield></datafield>' for _ in range(4))
    got = parsed(spark, f"<record>{long}</record>").select(marc.subject_string(F.col("fields"), "650", naco_normalize)).first()[0]
    assert got.startswith("!!!x") and got.endswith("!!!") and len(got) == 206
