"""Rows at places of an order, against a plain sort."""

import random

import pytest

from tallyhouse.operators.selection import rows_in_order
from tallyhouse.plans.rfm import last_of_bin


def _frame(spark, rows):
    return spark.createDataFrame(rows, "a long, `b.c` long, id string").repartition(4)


def _check(spark, rows, places, **limits):
    found = rows_in_order(_frame(spark, rows), "id", {"a": places, "b.c": places}, **limits)
    for i, column in enumerate(("a", "b.c")):
        ordered = sorted((row[i], row[2]) for row in rows)
        assert found[column] == [ordered[place - 1] for place in places]


@pytest.mark.parametrize("limits", [{}, {"few": 1, "parts": 3}, {"few": 7, "parts": 16}])
def test_equals_a_sort(spark, limits):
    chance = random.Random(3)
    rows = [
        (chance.choice([1, 1, 1, 2, 7, chance.randrange(-(10**6), 10**12)]), chance.randrange(4), f"{chance.choice(['', 'é', 'z'])}{i}")
        for i in range(500)
    ]
    _check(spark, rows, [1, 2, *last_of_bin(500), 499, 500], **limits)


def test_wide_values_prefixes_and_one_row(spark):
    wide = [(-(2**63), 5, ""), (2**63 - 1, 5, "a"), (0, 5, "aa"), (1, 5, "aab"), (1, 5, "b"), (-1, 5, "a\U0001f600")]
    _check(spark, wide, list(range(1, 7)), few=1, parts=5)
    _check(spark, [(3, 4, "x")], [1])
    _check(spark, [(3, 4, "x")] * 6, [1, 6], few=1)  # rows that cannot be told apart


def test_no_places(spark):
    assert rows_in_order(_frame(spark, [(1, 2, "x")]), "id", {"a": []}) == {"a": []}
