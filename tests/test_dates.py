import uuid
from datetime import date

import pytest

from rowgate import DateRule, Dialect, parse_spec
from rowgate.operators.load import tag_lines
from rowgate.sources.delimited import read_lines

SPEC = parse_spec("t|long|timestamp")


def read_dates(spark, put, rule, texts):
    """The timestamp, or the reject reason, of each text."""
    folder = put("".join(f"{t}\n" for t in texts), folder=uuid.uuid4().hex)
    tagged = tag_lines(read_lines(spark, folder, has_header=False), SPEC, Dialect("|"), rule)
    rows = tagged.orderBy("_load.row").selectExpr("coalesce(_load.reason, cast(t as string)) t").collect()
    return [r.t for r in rows]


def test_dates_by_pattern(spark, put):
    def read(pattern, zone, *texts):
        return read_dates(spark, put, DateRule(pattern, zone), texts)

    assert read("dd-MM-yyyy hh:mm:ss", "EST", "1-2-2020 13:00:00") == ["2020-02-01 18:00:00"]
    assert read("dd-MM-yyyy hh:mm:ss a", "UTC", "01-02-2020 01:00:00 PM") == ["2020-02-01 13:00:00"]
    assert read("yyyyMMdd'T'HHmmss", "UTC", "20200102T030405", "2020123") == [
        "2020-01-02 03:04:05",
        "1970-01-01 00:33:40.123",
    ]
    assert read("yyyy-MM-dd'T'HH:mm:ss.SSSZ", "EST", "2020-01-02T03:04:05.678+0100") == ["2020-01-02 02:04:05.678"]
    assert read("d MMM yyyy", "America/New_York", "4 Jul 2020", "4 Foo 2020") == ["2020-07-04 04:00:00", "bad_timestamp"]
    assert read(None, None, "2020-01-01", "5") == ["bad_timestamp", "1970-01-01 00:00:00.005"]
    assert read("yyyy/MM/dd", None, "2020/1/1") == ["2020-01-01 00:00:00"]


def test_zone_needs_a_utc_session(spark, put):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            tag_lines(read_lines(spark, put("t\n1\n")), parse_spec("t|long|timestamp"), dates=DateRule("yyyy", "EST"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_dates_roll_over(spark, put):
    cases = {
        "2020/01/02 03:04:05": "2020-01-02 03:04:05",
        "2020/13/45 00:00:00": "2021-02-14 00:00:00",
        "2020/0/0 0:0:0": "2019-11-30 00:00:00",
        "2019/2/29 25:61:61": "2019-03-02 02:02:01",
        "  2020/ 1/ 2 3:4:5 and more": "2020-01-02 03:04:05",
        "2020/1/2 3:4": "bad_timestamp",
        "2020-1-2 3:4:5": "bad_timestamp",
        "not-a-date": "bad_timestamp",
        "-5": "bad_timestamp",
        "9999999/1/1 0:0:0": "bad_timestamp",
        "1577836800000": "2020-01-01 00:00:00",
    }
    rule = DateRule("yyyy/MM/dd HH:mm:ss", "UTC", lenient=True)
    assert dict(zip(cases, read_dates(spark, put, rule, cases))) == cases
    assert read_dates(spark, put, rule, ["99999/99999/99999 999999999:999999999:999999999"])[0].startswith("+2")
    assert read_dates(spark, put, rule, ["294247/1/1 0:0:0", "1970/1/100000000 0:0:0", "1970/1/1 0:0:9000000000000"]) == [
        "+294247-01-01 00:00:00",
        "+275760-09-12 00:00:00",
        "+287168-08-24 16:00:00",
    ]
    for text in ["294248/1/1 0:0:0", "1/99999999/1 0:0:0", "1/1/1 999999999999999999:0:0", "1/1/9999999999999999999 0:0:0"]:
        assert read_dates(spark, put, rule, [text]) == ["bad_timestamp"]


@pytest.mark.parametrize("lenient", [False, True])
def test_both_readings(spark, put, lenient):
    def read(pattern, *texts):
        return read_dates(spark, put, DateRule(pattern, "UTC", lenient=lenient), texts)

    near = date.today().year + 20
    short = [f"1/2/{year % 100:02d}" for year in (near - 1, near + 1)]
    assert read("d/M/yy", *short, "1/2/2085", "1/2/123") == [
        f"{near - 1}-02-01 00:00:00",
        f"{near - 99}-02-01 00:00:00",
        "2085-02-01 00:00:00",
        "0123-02-01 00:00:00",
    ]
    assert read("yyMMdd HH", f"{(near + 1) % 100:02d}0203 04") == [f"{near - 99}-02-03 04:00:00"]
    hours = ["1-2-2020 12:30:00", "1-2-2020 13:30:00", "1-2-2020 0:30:00"]
    assert read("d-M-yyyy hh:mm:ss", *hours) == ["2020-02-01 00:30:00", "2020-02-01 13:30:00", "2020-02-01 00:30:00"]
    assert read("d-M-yyyy hh:mm a", "1-2-2020 12:30 AM", "1-2-2020 12:30 PM") == ["2020-02-01 00:30:00", "2020-02-01 12:30:00"]


def test_weekdays(spark, put):
    rule = DateRule("EEE, dd MMM yyyy", "UTC")
    texts = ["Sat, 04 Jul 2020", "saturday, 4 Jul 2020", "Fri, 04 Jul 2020", "Satan, 04 Jul 2020", "04 Jul 2020"]
    assert read_dates(spark, put, rule, texts) == ["2020-07-04 00:00:00"] * 3 + ["bad_timestamp"] * 2
    with pytest.raises(ValueError):
        DateRule("dd MMM yyyy EEE")


def test_lenient_fields(spark, put):
    def read(pattern, *texts, zone="UTC"):
        return read_dates(spark, put, DateRule(pattern, zone, lenient=True), texts)

    assert read("dd-MM-yyyy hh:mm:ss", "01-02-2020 12:30:00", "01-02-2020 13:00:00") == ["2020-02-01 00:30:00", "2020-02-01 13:00:00"]
    assert read("dd-MM-yyyy hh:mm a", "01-02-2020 12:30 am", "1-2-2020 12:30 PM") == ["2020-02-01 00:30:00", "2020-02-01 12:30:00"]
    assert read("yyyyMMdd'T'HHmmss", "20200102T030405xyz") == ["2020-01-02 03:04:05"]
    assert read("yyyy-MM-dd HH:mm:ss.SSS", "2020-01-02 03:04:05.7") == ["2020-01-02 03:04:05.007"]
    assert read("HH:mm", "05:06") == ["1970-01-01 05:06:00"]
    assert read("yyyy/MM/dd HH:mm", "2020/07/01 12:00", zone="America/New_York") == ["2020-07-01 16:00:00"]
    assert read("yyyy/MM/dd HH:mm", "2020/07/01 12:00", zone=None) == ["2020-07-01 12:00:00"]
    year = date.today().year
    near = (year + 20) // 100 * 100 + (year + 20) % 100 - 1
    assert read("d/M/yy", f"1/1/{near % 100:02d}", f"1/1/{(near + 3) % 100:02d}", "1/1/123") == [
        f"{near}-01-01 00:00:00",
        f"{near + 3 - 100}-01-01 00:00:00",
        "0123-01-01 00:00:00",
    ]


@pytest.mark.parametrize("pattern", ["d MMM yyyy", "yyyy-MM-dd Z", "EEE d", "d d"])
def test_lenient_patterns_are_numeric(pattern):
    with pytest.raises(ValueError):
        DateRule(pattern, lenient=True)


def test_lenient_numbers_may_have_any_number_of_zeros(spark, put):
    rule = DateRule("yyyy/MM/dd HH:mm", "UTC", lenient=True)
    texts = ["000002020/0000001/00000000002 0000000000003:4", "2020/01/02 03:04"]
    assert read_dates(spark, put, rule, texts) == ["2020-01-02 03:04:00"] * 2
