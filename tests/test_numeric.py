"""Exact averages of ratios against fractions, ties and negative values included."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from courtline.functions.numeric import avg_ratio_rounded, ratio_parts


def rounded(values, decimals):
    if not values:
        return None
    mean = sum(values, Fraction(0)) / len(values) * 10 ** decimals
    units = int(abs(mean) + Fraction(1, 2))
    return (-units if mean < 0 else units) / 10 ** decimals


def test_average_of_ratios_is_exact(spark):
    rng = random.Random(3)
    groups = [
        [(1, 3), (2, 3), (1, 20000), (-1, 1)],          # 1/20000 in four: far from a tie
        [(1, 3), (-1, 3), (1, 10000), (0, 7)],          # 1/40000: no tie
        [(1, 3), (-1, 3), (1, 10000)], [(1, 3), (2, 3), (-9999, 10000), (0, 1)],
        [(1, 20000)], [(-1, 20000)], [(1, 3), (-1, 3), (3, 20000), (3, 20000), (3, 20000), (3, 20000), (0, 1), (0, 2)],
        [(1, 7), (-1, 7), (-1, 10000)], [(-1, 6), (1, 15), (1, 10), (1, 10000)],                    # sums that only exact arithmetic finds equal
        [(1, 20001)], [(1, 19999)], [(0, 1)], [(2 ** 31 - 1, 2 ** 31 - 1), (-(2 ** 40), 2 ** 31 - 1)], [(None, 1)], [(None, 5), (1, 2)],
    ]
    groups += [[(rng.randrange(-60, 60), rng.choice([1, 7, 9, 15, 16, 23, 31])) for _ in range(rng.randrange(1, 9))] for _ in range(300)]
    # half of a unit of the last place, hidden in thirds and sevenths
    groups += [[(k, 3), (1, 7), (-1, 7), (-k, 3), (2 * j + 1, 5000), (0, 1), (0, 1), (0, 1)] for k in range(1, 8) for j in range(-9, 9)]
    rows = [(g, n, d) for g, v in enumerate(groups) for n, d in v]
    df = spark.createDataFrame(rows, "g int, n long, d int").repartition(7)
    got = {r.g: r.x for r in df.groupBy("g").agg(*ratio_parts("x", F.col("n"), F.col("d"))).select("g", avg_ratio_rounded("x", 4)).collect()}
    want = {g: rounded([Fraction(n, d) for n, d in v if n is not None], 4) for g, v in enumerate(groups)}
    assert got == want


def test_average_of_ratios_of_no_rows(spark):
    df = spark.createDataFrame([], "n long, d int")
    assert df.agg(*ratio_parts("x", F.col("n"), F.col("d"))).select(avg_ratio_rounded("x", 4)).first().x is None
