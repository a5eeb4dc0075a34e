"""Where the warehouse's functions differ from Spark's own."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plazaworks import vocab
from plazaworks.functions import dates as D
from plazaworks.functions import geo as G
from plazaworks.functions import jsonx as X
from plazaworks.functions import numbers as N
from plazaworks.functions import sem
from plazaworks.functions import text as T
from plazaworks.operators.rules import classify

ts = lambda s: F.lit(s).cast("timestamp_ntz")


def test_no_match_is_null(one):
    assert one(sem.regexp_extract_n(F.lit("abc"), r"(\d+)")) is None
    assert one(sem.regexp_extract_n(F.lit("a12"), r"(\d+)")) == "12"


def test_word_boundary_is_ascii(one):
    assert one(sem.regexp_extract_n(F.lit("caféla"), r"\b(la)")) == "la"
    assert one(sem.regexp_extract_n(F.lit("cafela"), r"\b(la)")) is None


def test_initcap_after_punctuation(one):
    assert one(sem.initcap_delims(F.lit("hello-world foo"))) == "Hello-World Foo"


def test_least_and_greatest_with_null(one):
    null = F.lit(None).cast("int")
    assert one(sem.least_strict(F.lit(1), null)) is None
    assert one(sem.greatest_strict(F.lit(1), null)) is None
    assert one(sem.least_strict(F.lit(3), F.lit(2))) == 2


def test_not_in_with_null(one):
    assert one(sem.not_in(F.lit(None).cast("string"), ["a"])) is None


def test_month_and_hour_boundaries(one):
    assert one(D.months_crossed(F.lit(date(2024, 2, 1)), F.lit(date(2024, 1, 31)))) == 1
    a, b = ts("2024-01-01 11:10:00"), ts("2024-01-01 10:50:00")
    assert one(D.hours_crossed(a, b)) == 1
    assert one(D.whole_hours(a, b)) == 0


def test_week_starts_on_sunday(one):
    for day in (date(2024, 1, 6), date(2024, 1, 7), date(2023, 12, 31), date(2021, 1, 2)):
        assert one(D.week_from_sunday(F.lit(day))) == int(day.strftime("%U"))


def test_local_time(one):
    assert one(D.to_local(ts("2024-01-01 03:00:00"))) == datetime(2023, 12, 31, 22, 0)


def test_safe_date_parse(one):
    assert one(D.parse_date(F.lit("31/02/2024"))) is None
    assert one(D.parse_date(F.lit("3/2/2024"))) == date(2024, 2, 3)
    with pytest.raises(Exception):
        one(D.parse_date(F.lit("31/02/2024"), strict=True))


@pytest.mark.parametrize(
    "raw, want",
    [("7/1072024", date(2024, 7, 10)), ("0/01/1900", None), ("#N/A", None), ("7/4/24", None), ("07/14/24", date(2024, 7, 14)), ("13/14/2024", None)],
)
def test_typed_dates(one, raw, want):
    assert one(D.repair_mdy(F.lit(raw))) == want


def test_work_time_by_hand(one):
    # Monday 10:00 to Wednesday 12:00, days 2..6 are Monday to Friday: two spans of nine hours and two hours
    w = D.work_time(ts("2024-01-03 12:00:00"), ts("2024-01-01 10:00:00"), 9, 18, [2, 3, 4, 5, 6])
    assert one(w["working_seconds"]) == (2 * 9 + 2) * 3600
    assert one(w["working_days"]) == 2
    assert one(w["hours"]) == 50


def test_reporting_window():
    assert D.reporting_window("2024-03-11") == (datetime(2024, 3, 8, 18), datetime(2024, 3, 11, 8))
    assert D.reporting_window("2024-03-12") == (datetime(2024, 3, 11, 18), datetime(2024, 3, 12, 8))
    assert D.reporting_window("2024-03-12", "pm") == (datetime(2024, 3, 12, 8), datetime(2024, 3, 12, 18))
    assert D.cutoff("2024-03-12") == datetime(2024, 3, 11, 22)


def test_text(one):
    assert one(T.fold_accents(F.lit("Ñandú"))) == "Nandu"
    assert one(T.fold_and_strip(F.lit("Añ,o/x-1"))) == "Anox 1"
    assert one(T.zero_pad(F.lit("12345"), 3)) == "12345"
    assert one(T.strip_float_tail(F.lit("10.0"))) == "10"
    assert one(T.normalise_units(F.lit("Aceite 5 Litros"))) == "aceite 5l"
    assert one(T.pack_quantity(F.lit("caja 12un"))) == 12
    assert one(T.dimension_unit(F.lit("sin nada"))) == "un"


def test_numbers(one):
    assert one(N.repair_coordinate(F.lit("-12047548"))) == pytest.approx(-12.047548)
    assert one(N.decimal_comma(F.lit("1,5"))) == 1.5
    assert one(N.whole_units(F.lit(-30.0), F.lit(20.0))) == -20.0
    assert one(N.money_from_cents(F.lit("1050"), F.lit("100"))) == 10.5
    assert one(N.money_from_cents(F.lit("1050"), F.lit("0"))) is None
    assert one(N.round_half_even(F.lit(2.5))) == 2
    assert one(N.percent_text(F.lit(0.1234))) == "12.34%"


def test_json(one):
    assert one(X.scalar(F.lit('{"a": {"b": 1}}'), "$.a")) is None
    assert one(X.lax_string(F.lit("not json"), "a")) is None
    assert one(X.first_of_paths(F.lit('{"x": {"v": [7]}}'), ["$.q", "$.x.v[0]"])) == "7"
    assert one(X.unquoted(F.lit('{"a": "b"}'), "$.a")) == "b"


def test_distance_is_null_without_a_point(one):
    assert one(G.geodesic_m(F.lit(0.0), F.lit(0.0), F.lit(None).cast("double"), F.lit(1.0))) is None
    assert one(G.geodesic_m(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(111195, rel=1e-4)


def test_rule_lists_first_match(one):
    reason = lambda s: one(classify(F.lit(s), vocab.RETURN_REASONS, vocab.RETURN_REASON_OTHER))
    assert reason("pide talla m") == "Error de talla"
    assert reason("quiere cambiar") == "Cambio de producto"
    assert reason("pantalla negra") == "Otro"
