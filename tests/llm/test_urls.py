"""Entries of one value that block and allow, times within a day, ties, very long urls and empty tables."""

import datetime

from tripweave.llm import url_filter

AT = datetime.datetime(2024, 1, 1)
EVENTS = "value string, verdict string, day timestamp, added boolean"
CAPTURES = "page_id long, url string, fetched timestamp"


def hour(n):
    return AT + datetime.timedelta(hours=n)


def judged(spark, captures, events):
    frame = spark.createDataFrame(captures, CAPTURES)
    return {r["page_id"]: (r["n_active"], r["decided_by"], r["blocked"]) for r in url_filter.judge_captures(
        frame, url_filter.validity(spark.createDataFrame(events, EVENTS))).collect()}


def test_a_value_holds_both_verdicts(spark):
    events = [("a.example", "block", hour(1), True), ("a.example", "allow", hour(3), True), ("a.example", "allow", hour(5), False),
              ("a.example", "block", hour(7), False), ("b.example", "allow", hour(0), True), ("b.example", "block", hour(2), False)]
    captures = [(i, "http://a.example/x", hour(i)) for i in range(9)] + [(20, "b.example", hour(4))]
    got = judged(spark, captures, events)
    assert [got[i][2] for i in range(9)] == [False, *[True] * 6, False, False]
    assert [got[i][0] for i in range(9)] == [0, 1, 1, 2, 2, 1, 1, 0, 0]
    assert got[20] == (1, "b.example", False)


def test_times_within_a_day_count(spark):
    got = judged(spark, [(1, "c.example/p", hour(9)), (2, "c.example/p", hour(18))], [("c.example", "block", hour(17), True)])
    assert got == {1: (0, None, False), 2: (1, "c.example", True)}


def test_ties_long_urls_and_renewals(spark):
    path = "/" + "/".join(f"d{i}" for i in range(400))
    events = [("d.example" + path, "block", hour(0), True), ("x.d.example", "allow", hour(0), True), ("d.example/d0", "block", hour(0), True),
              ("e.example", "block", hour(0), True), ("e.example", "block", hour(2), True), ("e.example", "block", hour(4), False),
              ("e.example", "block", hour(4), True)]
    got = judged(spark, [(1, "http://d.example" + path + "/", hour(1)), (2, "d.example/d0/zzz", hour(1)), (3, "x.d.example/" + "y" * 200_000, hour(1)),
                         (4, "e.example", hour(3)), (5, "e.example", hour(4))], events)
    assert got[1] == (2, "d.example" + path, True) and got[2] == (1, "d.example/d0", True) and got[3] == (1, "x.d.example", False)
    assert got[4] == (1, "e.example", True) == got[5]


def test_empty_tables(spark):
    none = spark.createDataFrame([], EVENTS)
    assert judged(spark, [(1, "a.example", hour(1))], [("b.example", "block", hour(0), False)]) == {1: (0, None, False)}
    frame = spark.createDataFrame([(1, "a.example", hour(1))], CAPTURES)
    assert [r["blocked"] for r in url_filter.judge_captures(frame, url_filter.validity(none)).collect()] == [False]
    assert url_filter.judge_captures(frame.limit(0), url_filter.validity(none)).count() == 0
