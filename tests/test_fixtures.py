"""Golden tests on the reference's own input files (values from FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.plans import jobs


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_word_count(spark, ref_input, tmp_path):
    out = str(tmp_path / "wc")
    counts = jobs.word_count(spark, f"{ref_input}/wc.txt", output=out)
    assert dict(_rows(counts, "word", "n")) == {
        "Nana": 2, "Nanaho": 2, "Nate": 1, "Nicole": 7, "Nipul": 6, "Nipun": 2, "Noel": 1, "Noman": 12}
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert "Noman 12" in lines and len(lines) == 8


def test_word_count_without_output_writes_nothing(spark, ref_input, tmp_path):
    jobs.word_count(spark, f"{ref_input}/wc.txt")
    assert list(tmp_path.iterdir()) == []


JOIN_INNER = [(1, "John", "DC"), (2, "Albert", "NY"), (4, "Smith", "LA")]


def test_joins(spark, ref_input):
    p, l = f"{ref_input}/person.txt", f"{ref_input}/location.txt"
    get = lambda how: _rows(jobs.join_people(spark, p, l, how), "id", "name", "state")
    assert get("inner") == JOIN_INNER
    assert get("left") == sorted(JOIN_INNER + [(3, "Lui", "NULL"), (5, "Robert", "NULL")])
    assert get("right") == sorted(JOIN_INNER + [(6, "NULL", "LU"), (7, "NULL", "DL"), (8, "NULL", "NH")])
    assert get("full") == sorted(JOIN_INNER + [(3, "Lui", "NULL"), (5, "Robert", "NULL"), (6, "NULL", "LU"),
                                               (7, "NULL", "DL"), (8, "NULL", "NH")])


def test_final_per_month_small(spark, ref_input):
    f = {r["month"]: r for r in jobs.final_sales(spark, f"{ref_input}/avg1.txt").collect()}
    assert (f["June"]["n"], f["June"]["sum_profit"]) == (9, 232)
    assert (f["July"]["n"], f["July"]["sum_profit"]) == (3, 89)
    assert (f["August"]["n"], f["August"]["sum_profit"]) == (6, 212)
    assert (f["June"]["first_category"], f["June"]["first_product"]) == ("Category5", "Bat")
    assert (f["June"]["argmin_category"], f["June"]["argmin_product"], f["June"]["min_profit"]) == \
        ("Category4", "Perfume", 10)
    # June's maximum 41 occurs twice (Bat, then Tablet): the first one wins
    assert (f["June"]["argmax_category"], f["June"]["argmax_product"], f["June"]["max_profit"]) == \
        ("Category5", "Bat", 41)
    assert (f["July"]["argmin_product"], f["July"]["argmax_product"]) == ("Pendrive", "Television")
    assert (f["August"]["argmin_category"], f["August"]["argmin_product"]) == ("Category2", "PC")
    assert (f["August"]["argmax_category"], f["August"]["argmax_product"]) == ("Category5", "Steamer")


def test_rolling_sales_last_rows_match_final(spark, ref_input):
    out = jobs.rolling_sales(spark, f"{ref_input}/avg1.txt")
    last = lambda df: {r["month"]: r for r in
                       df.withColumn("mx", F.max("seq").over(__import__("pyspark.sql", fromlist=["Window"])
                                                             .Window.partitionBy("month")))
                       .filter("seq = mx").collect()}
    s, mb, xb = last(out["sum"]), last(out["minBy"]), last(out["maxBy"])
    assert (s["June"]["profit"], s["June"]["category"], s["June"]["product"]) == (232, "Category5", "Bat")
    assert (mb["June"]["product"], mb["June"]["profit"]) == ("Perfume", 10)
    assert (xb["June"]["product"], xb["June"]["profit"]) == ("Bat", 41)
    # one output row per input row
    assert out["sum"].count() == 18


def test_average_profit(spark, ref_input):
    a = jobs.average_profit(spark, f"{ref_input}/avg.txt")
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("month")
    last = {r["month"]: r["avg_profit"] for r in
            a.withColumn("mx", F.max("seq").over(w)).filter("seq = mx").collect()}
    assert last == {"June": 2336 / 82, "July": 2577 / 81, "August": 3175 / 95}


def test_count_trigger_sales(spark, ref_input):
    t = jobs.count_trigger_sales(spark, f"{ref_input}/avg.txt", every=5)
    by = {}
    for r in t.orderBy("seq").collect():
        by.setdefault(r["month"], []).append(r)
    assert len(by["June"]) == 16 and len(by["July"]) == 16 and len(by["August"]) == 19
    assert [r["total"] for r in by["June"][:2]] == [140, 255] and by["June"][-1]["total"] == 2275
    assert [r["total"] for r in by["July"][:2]] == [134, 297] and by["July"][-1]["total"] == 2557
    assert [r["total"] for r in by["August"][:2]] == [162, 355] and by["August"][-1]["total"] == 3175
    assert {(m, rs[0]["first_category"], rs[0]["first_product"]) for m, rs in by.items()} == {
        ("June", "Category5", "Bat"), ("July", "Category1", "Television"), ("August", "Category5", "PC")}


def test_split_numbers(spark, ref_input):
    parts = jobs.split_numbers(spark, f"{ref_input}/oddeven.txt")
    assert parts["even"].count() == 24 and parts["odd"].count() == 19
    assert parts["main"].count() == 43
    assert parts["main"].agg(F.sum("n")).first()[0] == 1_028_995  # awk over the file agrees
    assert dict(parts["even"].dtypes)["n"] == "string" and dict(parts["odd"].dtypes)["n"] == "int"


def test_iterate(spark):
    out = jobs.iterate_to_ten(spark, 0, 5)
    assert _rows(out, "n", "m") == sorted([(10, 10), (10, 9), (10, 8), (10, 7), (10, 6), (10, 5)])


def test_department_counts(spark, ref_input):
    d = jobs.department_counts(spark, f"{ref_input}/broadcast.txt", f"{ref_input}/broadcast_small.txt")
    assert d.count() == 399
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("dept")
    last = {r["dept"]: r["n"] for r in d.withColumn("mx", F.max("seq").over(w)).filter("seq = mx").collect()}
    assert last == {"Development": 59, "Finance": 60, "Marketing": 59, "Production": 52, "Purchase": 64,
                    "Safety": 58, "Stores": 47}


def test_reading_windows_and_keyed_count_windows(spark, tmp_path):
    readings = tmp_path / "readings.txt"
    readings.write_text("0,1\n1000,2\n2001,4\n5000,8\n")
    sess = sorted((r.session_start.timestamp(), r.session_end.timestamp(), r.total)
                  for r in jobs.reading_windows(spark, str(readings), "session").collect())
    assert sess == [(0.0, 2.0, 3), (2.001, 3.001, 4), (5.0, 6.0, 8)]
    slid = {(r.window_start.timestamp(), r.total) for r in jobs.reading_windows(spark, str(readings)).collect()}
    assert slid == {(-2.0, 3), (0.0, 7), (2.0, 4 + 8), (4.0, 8)}   # 4 s windows every 2 s, epoch-aligned
    kn = tmp_path / "kn.txt"
    kn.write_text("".join(f"{k},{i}\n" for i in range(12) for k in (5, 6)))
    got = sorted((r.key, r.window_no, r.total) for r in jobs.keyed_count_windows(spark, str(kn)).collect())
    assert got == [(5, 0, 45), (6, 0, 45)]
    lst = jobs.keyed_count_windows(spark, str(kn), with_values=True).collect()
    assert sorted(r["values"] for r in lst) == [" 0 1 2 3 4 5 6 7 8 9"] * 2
