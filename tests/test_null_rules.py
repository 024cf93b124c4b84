"""Null, tie and order rules of the relational operators."""

import pytest
from pyspark.sql import functions as F

from tracewater.operators import columns, first, joins, order, reshape
from tracewater.operators import rows as rowsets


def test_null_safe_join_pairs_nulls(frame, rows):
    left = frame("id int, k string", (1, "a"), (2, None), (3, "x"))
    right = frame("k string, v int", ("a", 10), (None, 20), ("b", 30))
    assert rows(joins.null_safe_join(left, right, ["k"])) == [(1, "a", 10), (2, None, 20), (3, "x", None)]


def test_strict_join_never_pairs_nulls(frame, rows):
    left = frame("id int, k string", (1, "a"), (2, None), (3, None))
    right = frame("k string, v int", ("a", 10), (None, 20))
    assert rows(joins.strict_join(left, right, ["k"])) == [(1, "a", 10), (2, None, None), (3, None, None)]
    assert rows(joins.strict_join(left, right, ["k"], "inner")) == [(1, "a", 10)]


def test_multikey_join_pairs_null_part_many_to_many(frame, rows):
    left = frame("id int, d string, b string, s string", (1, "D", "B", None), (2, "D", "B", "S"))
    right = frame("d string, b string, s string, code string", ("D", "B", None, "x"), ("D", "B", None, "y"), ("D", None, "S", "z"))
    got = rows(joins.null_safe_join(left, right, ["d", "b", "s"]).select("id", "code"))
    assert got == [(1, "x"), (1, "y"), (2, None)]


def test_keep_keys_and_suffix(frame):
    left = frame("k string, v int", ("a", 1))
    right = frame("k string, v int", ("a", 2))
    kept = joins.null_safe_join(left, right, ["k"], keep_keys=True)
    assert kept.columns == ["k", "v", "k_right", "v_right"]
    assert tuple(kept.first()) == ("a", 1, "a", 2)


@pytest.mark.parametrize("with_null, inside, outside", [(True, [("a",), (None,)], [("b",)]), (False, [("a",)], [("b",), (None,)])])
def test_membership_with_null(frame, rows, with_null, inside, outside):
    df = frame("k string", ("a",), ("b",), (None,))
    keys = frame("k string", *[("a",), ("a",)] + ([(None,)] if with_null else []))
    sort = lambda found: sorted(found, key=str)
    assert sort(rows(joins.in_set(df, keys, ["k"]))) == sort(inside)
    assert sort(rows(joins.not_in_set(df, keys, ["k"]))) == sort(outside)


def test_columnwise_membership_is_not_tuple_membership(frame, rows):
    df = frame("a string, b string", ("1", "2"), ("2", "1"), ("1", "9"), (None, "1"))
    keys = frame("a string, b string", ("1", "1"), ("2", "2"))
    assert rows(joins.in_each_column(df, keys, ["a", "b"])) == [("1", "2"), ("2", "1")]


def test_join_with_attribute_drops_empty_attribute(frame, rows):
    left = frame("k string", ("a",), ("b",), ("c",))
    right = frame("k string, process string", ("a", "p"), ("b", None))
    assert rows(joins.join_with_attribute(left, right, ["k"], "process")) == [("a", "p")]


def test_full_merge_equals_full_outer(frame, rows):
    left = frame("cas string, plant string, a string", ("1", "P", "x"), ("1", "P", "y"), ("2", "P", None), (None, "P", "n"), ("3", None, "m"))
    right = frame("code string, plant string, b string", ("1", "P", "r"), ("2", "P", "s"), ("4", "Q", "t"), (None, "P", "u"))
    got = joins.full_merge(left, right, [("cas", "code"), "plant"], coalesce=[("a", "b", "label")])
    assert got.columns == ["cas", "plant", "label"]
    expected = left.join(right.withColumnRenamed("code", "cas"), ["cas", "plant"], "full").select("cas", "plant", F.coalesce("a", "b").alias("label"))
    assert rows(got) == rows(expected)


def test_full_merge_rejects_clash(frame):
    with pytest.raises(ValueError, match="both sides"):
        joins.full_merge(frame("k string, v int", ("a", 1)), frame("k string, v int", ("a", 1)), ["k"])


def test_sort_puts_nulls_last_both_ways(frame):
    df = frame("a int, b int", (1, 1), (None, 2), (2, 3))
    assert [r.b for r in order.sort_nulls_last(df, "a").collect()] == [1, 3, 2]
    assert [r.b for r in order.sort_nulls_last(df, "-a").collect()] == [3, 1, 2]


def test_keep_first_over_partitions_and_null_key(frame, rows):
    df = frame("k string, o int, v string", ("a", 2, "late"), ("a", 1, "early"), (None, 3, "n3"), (None, 1, "n1"), ("b", None, "only")).repartition(5)
    assert rows(first.keep_first(df, ["k"], ["o"]).select("k", "v")) == [(None, "n1"), ("a", "early"), ("b", "only")]
    assert rows(first.keep_first(df, ["k"], ["o"], drop_null_keys=True).select("k", "v")) == [("a", "early"), ("b", "only")]


def test_chain_keeps_one_row_for_missing_smiles(frame, rows):
    df = frame("cas string, smiles string", ("1", "CC"), ("1", "CCC"), ("2", "CC"), ("3", None), ("4", None))
    got = first.keep_first_chain(df, [["cas"], ["smiles"]], ["cas", "smiles"])
    assert rows(got) == [("1", "CC"), ("3", None)]


def test_mark_duplicates_both_null_variants(frame, rows):
    df = frame("id int, k string", (1, "a"), (2, "a"), (3, "b"), (4, None), (5, None))
    assert [r[2] for r in rows(first.mark_duplicates(df, ["k"]))] == [True, True, False, True, True]
    assert [r[2] for r in rows(first.mark_duplicates(df, ["k"], null_is_value=False))] == [True, True, False, False, False]


def test_top_k_keeps_ties(frame, rows):
    totals = [("P", f"g{i:02d}", 100 - i) for i in range(19)] + [("P", "g19", 50), ("P", "g20", 50), ("P", "g21", 1)]
    got = first.top_k_with_ties(frame("plant string, g string, total int", *totals), ["plant"], ["-total"], 20)
    assert {r.g for r in got.collect()} == {f"g{i:02d}" for i in range(21)}


def test_except_rows_treats_nulls_equal(frame, rows):
    left = frame("a int, b string", (1, None), (1, None), (2, "x"), (3, "y"))
    right = frame("a int, b string", (1, None), (9, "z"))
    assert rows(rowsets.except_rows(left, right)) == [(2, "x"), (3, "y")]


def test_append_widen(frame, rows):
    got = rowsets.append_widen(frame("a int, b string", (1, "x")), frame("a double, c int", (1.5, 7)))
    assert rows(got) == [(1.0, "x", None), (1.5, None, 7)]
    with pytest.raises(TypeError, match="cannot append"):
        rowsets.append_widen(frame("a int", (1,)), frame("a string", ("x",)))


def test_first_of_rest_keeps_null_first(frame, rows):
    df = frame("g string, o int, v string", ("a", 1, None), ("a", 2, "x"), ("b", 5, "y"))
    assert rows(rowsets.first_of_rest(df, "v", ["o"])) == [("a", None), ("b", "y")]
    assert rows(rowsets.first_of_rest(df.drop("o"), "v", ["v"])) == [("a", "x"), ("b", "y")]


def test_coverage(frame):
    df = frame("k string, m string", ("a", "x"), ("b", None), (None, None))
    r = rowsets.coverage(df, F.col("m").isNotNull(), ["k"]).first()
    assert (r.n_rows, r.n_matched, r.n_unmatched, r.matched_pct, r.n_k) == (3, 1, 2, 33.3, 3)
    empty = rowsets.coverage(df.where("false"), F.col("m").isNotNull(), ["k"]).first()
    assert empty.matched_pct is None and empty.n_k == 0


def test_pivot_measures_without_a_status(frame, rows):
    df = frame("id int, status string, n int, c int", (1, "possible", 4, 2), (2, "possible", 5, 1))
    wide = reshape.pivot_measures(df, ["id"], "status", {"expected": "exp", "possible": "pos"}, ["n", "c"])
    assert wide.columns == ["id", "n_exp", "n_pos", "c_exp", "c_pos", "exp", "pos"]
    assert rows(wide) == [(1, None, 4, None, 2, None, 1), (2, None, 5, None, 1, None, 1)]


def test_pivot_flags(frame, rows):
    df = frame("id int, code string", (1, "20.1"), (1, "01.1"), (2, "20.1"), (2, None))
    assert rows(reshape.pivot_flags(df, ["id"], "code", ["01.1", "20.1"])) == [(1, 1, 1), (2, None, 1)]


def test_group_text_puts_single_substances_first(frame, rows):
    df = frame("id int, g string", (1, "ZZS b"), (1, "Individuele stoffen"), (1, "ZZS a"), (1, "ZZS a"), (2, "ZZS b"), (3, None))
    got = reshape.group_text(df, ["id"], "g", "groups", first_tag="Individuele stoffen")
    assert rows(got) == [(1, "Individuele stoffen, ZZS a, ZZS b"), (2, "ZZS b"), (3, "")]


LISTS = {"codes": ", ", "sectors": " | "}


def test_explode_parallel_pairs_recycles_and_keeps_null(frame, rows):
    df = frame("id int, codes string, sectors string", (1, "1, 2", "a | b"), (2, "3, 4", "c"), (3, "5", "d | e"), (4, None, "f"), (5, None, None))
    got = rows(reshape.explode_parallel(df, LISTS))
    assert got == [(1, "1", "a"), (1, "2", "b"), (2, "3", "c"), (2, "4", "c"), (3, "5", "d"), (3, "5", "e"), (4, None, "f"), (5, None, None)]


def test_explode_parallel_uneven(frame, rows):
    df = frame("id int, codes string, sectors string", (1, "1, 2", "a | b | c"))
    with pytest.raises(Exception, match="list of length 2 beside one of length 3"):
        reshape.explode_parallel(df, LISTS).collect()
    assert rows(reshape.explode_parallel(df, LISTS, on_mismatch="null")) == [(1, None, "c"), (1, "1", "a"), (1, "2", "b")]
    assert tuple(reshape.uneven_lists(df, LISTS).first()) == (1, 1)


def test_valid_on(frame, rows):
    df = frame("id int, b string, e string", (1, "2020-01-01", "2021-01-01"), (2, "2021-01-02", None), (3, "2021-01-01", "2030-01-01"))
    df = df.select("id", F.col("b").cast("date").alias("begin_geldigheid"), F.col("e").cast("date").alias("eind_geldigheid"))
    assert [r.id for r in columns.valid_on(df, "2021-01-01").orderBy("id").collect()] == [1, 3]
    assert columns.valid_on(df, None).count() == 3
    with pytest.raises(ValueError, match="validity"):
        columns.valid_on(df.drop("eind_geldigheid"), "2021-01-01")


def test_column_helpers(frame, rows):
    df = frame("a int, b int, c int, d int", (1, None, 3, None), (None, None, None, 4))
    assert columns.col_range(df, "b", "d") == ["b", "c", "d"]
    with pytest.raises(ValueError):
        columns.col_range(df, "d", "b")
    assert columns.front(df, "c").columns == ["c", "a", "b", "d"]
    assert columns.drop_empty_rows(df, ["a", "b", "c"]).count() == 1
    assert columns.rename_all(frame("X1 int, `Begin geldigheid nu` int", (1, 2)), columns.domain_header).columns == ["guid", "begin_geldigheid nu"]
    named = columns.match_names(frame("naam string", ("Bath Zuid",), ("Dinther",), (None,)), "naam", ["bath", "DINT", "zuid"], "plant")
    assert rows(named) == [("Bath Zuid", "bath"), ("Bath Zuid", "zuid"), ("Dinther", "DINT")]
