from datetime import datetime

from pyspark.sql import functions as F

from rosterlift.functions import codes, contact, dates, ids, location, money, names, predicates, text


def test_uuid_shape_and_null(spark):
    row = spark.range(1).select(ids.uuid_from("acme", F.lit(7)).alias("a"), ids.uuid_from("acme", F.lit(None)).alias("b"),
                                F.md5(F.lit("acme7")).alias("m")).first()
    assert row.a.replace("-", "") == row.m and [len(p) for p in row.a.split("-")] == [8, 4, 4, 4, 12]
    assert row.b is None


def test_compact_texts_come_back(spark):
    texts = ["0123abcd-0123-4567-89ab-0123456789ab", "0123ABCD-0123-4567-89ab-0123456789ab", "0123abcd012345678", "u", "", "tü漢", None]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    packed = df.select("v", ids.compact(F.col("v")).alias("b"))
    assert all(r.v == r.w for r in packed.select("v", ids.expanded(F.col("b")).alias("w")).collect())
    assert [len(r.b) for r in packed.collect() if r.b is not None] == [17, 37, 18, 2, 1, 7]


def test_email_norm(values):
    assert values(contact.email_norm, ["  John.Doe@GMAIL.com ", "<a b@c.com>;", "", None, "\ta@b.c"]) == [
        "john.doe@gmail.com", "ab@c.com", "", None, "a@b.c"]


def test_phone_norm(values):
    assert values(contact.phone_norm, ["+44 20", " 0044 20", "(020) 1-2", "+", "ext", "", None]) == [
        "+4420", "+4420", "02012", "+", None, None, None]


def test_url_norms(values):
    assert values(contact.linkedin_norm, ["https://www.linkedin.com/in/Ab/", "http://x.y//", " www. a "]) == [
        "linkedin.com/in/Ab", "x.y", "a"]
    assert values(contact.website_norm, ["https://WWW.Site.com/"]) == ["site.com"]
    assert values(contact.profile_url, ["see https://www.linkedin.com/in/a?x=1", "none", None]) == ["linkedin.com/in/a", None, None]


def test_personal_email_is_never_null(values):
    assert values(contact.is_personal_email, ["a@gmail.co.uk", "a@me.com", "a@me.com.au", "a@notme.com", "noat", None]) == [
        True, True, False, False, False, False]


def test_identity_shape(values):
    assert values(contact.identity_shape, ["a@b.c", "linkedin.com/in/x", "www.a.com", "+44 2079", "hi", None]) == [
        "email", "linkedin", "website", "phone", None, None]


def test_repair_email(values):
    assert values(contact.repair_email, ["bob-corp.com", "Bob@corp.com", "plain"]) == ["bob@corp.com", "bob@corp.com", "plain"]


def test_clean_html_is_one_line(values):
    page = "<p>Hi&nbsp;<b>you</b></p><SCRIPT>if (a<b) x()</SCRIPT><style>p{}</style><br/>bye"
    assert values(text.clean_html, [page, None]) == ["Hi you bye", None]


def test_markdown(values):
    assert values(text.html_to_markdown, ["<h1>T</h1><b>x</b><em>y</em><li>z</li>"]) == ["\n# T\n**x**_y_\n- z"]


def test_sections_skip_blanks(spark):
    df = spark.createDataFrame([("a", " ", None)], "x string, y string, z string")
    assert df.select(text.sections([("X: ", "x"), ("Y: ", "y"), ("Z: ", "z")])).first()[0] == "X: a"


def test_comma_cleanup_and_shorten(values):
    assert values(text.comma_cleanup, [",,a,,,b,", ""]) == ["a, b", ""]
    assert values(text.shorten, ["x" * 51, "x" * 50]) == ["x" * 47 + "...", "x" * 50]


def test_string_to_timestamp_reads_both_orders(values):
    assert values(dates.string_to_timestamp, ["09/10/2020 12:06:47", "2020-10-09 01:02:03", "2020-10-09T01:02:03Z", "09/10/2020",
                                              "2020-10-09", "31/02/2020", "soon", None]) == [
        "2020-10-09T12:06:47", "2020-10-09T01:02:03", "2020-10-09T01:02:03", "2020-10-09T00:00:00", "2020-10-09T00:00:00", None, None, None]


def test_iso_truncates_fractions(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, 900000),)], "t timestamp")
    assert df.select(dates.iso("t"), dates.iso("t", "midnight_zulu"), dates.iso("t", "millis")).first()[:] == (
        "2024-01-02T03:04:05", "2024-01-02T00:00:00Z", "2024-01-02T03:04:05.900")


def test_epoch(values):
    assert values(dates.epoch_midnight, ["1700000000", "x", None]) == ["2023-11-14T00:00:00", None, None]


def test_year_month(spark):
    df = spark.createDataFrame([(2001, 2, "false"), (2001, 13, None), (0, 1, "true")], "y int, m int, c string")
    got = df.select(dates.year_month_start("y", "m", F.lit("today")), dates.year_month_end("y", "m", "c")).collect()
    assert [tuple(r) for r in got] == [("2001-02-01", "2001-02-30"), ("2001-01-01", "2001-12-30"), ("today", None)]


def test_numbers(values):
    assert values(lambda c: money.nth_number(c, 1), ["50,000 - 60,000", "£70k", "80.5", "NA", None]) == [50000, 70, 81, None, None]
    assert values(lambda c: money.nth_number(c, 2), ["50,000 - 60,000", "80.5"]) == [60000, None]
    assert values(money.plain_amount, ["45000", " 80.5 ", "1,000", ""]) == [45000, 81, None, None]
    assert values(money.whole_part, ["£1,234.56", None, "words"]) == [1234, None, None]


def test_bonus_percent_or_amount(spark):
    df = spark.createDataFrame([(1000, 10), (1000, 500), (None, 10), (None, None)], "base bigint, bonus bigint")
    assert [tuple(r) for r in df.select(money.bonus_amount("base", "bonus"), money.total_pay("base", "bonus")).collect()] == [
        (100.0, 1100), (500.0, 1500), (10.0, 10), (None, None)]


def test_range_text(spark):
    df = spark.createDataFrame([(0, 5), (5, 0), (1, 2), (0, 0), (None, 3)], "a int, b int")
    assert [r[0] for r in df.select(money.range_text("a", "b")).collect()] == ["5", "5", "1 - 2", None, "3"]


def test_location(spark):
    df = spark.createDataFrame([("1 High St.", "", "Città", None), ("", None, "", None)], "a string, b string, c string, d string")
    assert [r[0] for r in df.select(location.location_locality("a", "b", "c", "d")).collect()] == ["1 High St , Citt", None]


def test_placeholders(values):
    assert values(location.clean_placeholder, ["n/a", " 0 ", "http://x", "12", "Rome"]) == [None, None, None, "12", "Rome"]
    assert values(lambda c: location.clean_placeholder(c, digits_ok=False), ["12"]) == [None]


def test_names(values):
    people = ["Mary Ann Smith", "Prince", "Bob Jones (ex)", "Eve (open", None]
    assert values(names.first_name, people) == ["Mary", "Prince", "Bob", "Eve", None]
    assert values(names.last_name, people) == ["Ann Smith", "", "Jones ", "", None]
    assert values(names.degree_part, ["BA, Arts, History", "MBA", " "]) == ["BA, Arts", "MBA", None]
    assert values(names.field_of_study_part, ["BA, Arts, History", "MBA"]) == ["History", None]
    assert values(names.basename, ["a/b/c.pdf"]) == ["c.pdf"]
    assert values(names.file_extension, ["a.b.pdf", "none"]) == ["pdf", "none"]


def test_codes(values):
    assert values(lambda c: codes.code_groups(c, {"x": ["A", "b"], "y": ["b", "c"]}, "z"), [" B ", "c", None, "q"]) == ["x", "y", "z", "z"]
    assert values(lambda c: codes.first_pattern(c, [("%on%", 1), ("%off%", 2)]), ["ON", "off", "-", None]) == [1, 2, None, None]
    assert values(codes.headcount_range, [0, None, 10, 11, 10000, 10001], "int") == [None, None, "1-10", "11-50", "5001-10000", "10000+"]
    assert values(codes.country_name, [2245, 5, None], "int") == ["France", None, None]


def test_soft_delete_drops_null_flags(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id int, f int")
    assert [r.id for r in df.where(predicates.is_live("f")).collect()] == [1]
    assert [r.id for r in df.where(predicates.is_live("f", "no_date")).collect()] == [3]


def test_filter_without_configuration_keeps_all(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    assert df.where(predicates.in_filter("v", None)).count() == 2
    assert df.where(predicates.in_filter("v", ["A"])).count() == 1


def test_person_rows(spark):
    df = spark.createDataFrame([("Bob", "b@x.y"), ("b@x.y", None), ("info", "Info"), (None, None)], "n string, e string")
    assert [r[0] for r in df.select(predicates.is_person_row("n", "e")).collect()] == [True, False, False, True]
