"""Whitening against whole numbers and numpy on one machine."""

import math
from fractions import Fraction

import numpy as np
import pytest

from pricetide.llm import whitening
from pricetide.llm.catalog import op11_whitening
from tests.llm.conftest import SF_DIR


def plain(rows, components=16):
    """{component: ...} by Python integers and one covariance matrix of products."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(k, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for k, v in kept]
    fit = sorted({x for _, x in xs})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dims)]
    centred = [[n * x[i] - sums[i] for i in range(dims)] for x in fit]
    v = np.array(
        [[float(Fraction(sum(c[i] * c[j] for c in centred), n**3)) for j in range(dims)] for i in range(dims)]
    )
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = []
    for key, x in xs:
        away = [n * a - s for a, s in zip(x, sums)]
        whitened = (np.array([float(Fraction(a, n)) for a in away]) @ axes) / np.sqrt(values)
        out.append((key, n, sum(a * a for a in away), whitened, values / np.trace(v)))
    return out


def compare(found, expected):
    rows = {}
    for r in found:
        rows.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    wanted = {}
    for key, n, deviation, whitened, explained in expected:
        wanted.setdefault((key, deviation), []).append((n, whitened, explained))
    assert rows.keys() == wanted.keys()
    signs = {}
    for name, group in rows.items():
        assert len(group) == sum(len(w) for _, w, _ in wanted[name])
        n, whitened, explained = wanted[name][0]
        for r in group:
            c = r["component"] - 1
            if c not in signs and abs(whitened[c]) > 1e-6:
                signs[c] = math.copysign(1, whitened[c] * r["whitened"])
            assert r["n"] == n
            assert r["whitened"] == pytest.approx(signs.get(c, 1) * whitened[c], rel=1e-7, abs=1e-7)
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9


def test_query_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    found = op11_whitening(spark, SF_DIR)
    assert dict(found.dtypes) | {"vec_id": "bigint"} == {
        "vec_id": "bigint",
        "component": "int",
        "n": "bigint",
        "deviation": "bigint",
        "whitened": "double",
        "explained": "double",
        "identity_error": "double",
    }
    compare(found.collect(), plain(rows))


def test_odd_rows(spark):
    """Nulls, non-finite and very large entries, repeated and short vectors, a mean far off, a clashing column."""
    rng = np.random.default_rng(5)
    far = (rng.normal(size=(300, 5)) + [1e9, -3e8, 0, 5, 1e9]).tolist()
    good = [(i % 250, v) for i, v in enumerate(far)] + [(None, far[0])] * 400 + [(7, far[3])]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [1.0, float("nan"), 0.0, 0.0, 0.0])]
    bad += [(904, [float("-inf")] * 5), (905, [1.0, 2.0])]
    df = spark.createDataFrame(
        [(k, v, 1, 2) for k, v in good + bad], "vec_id bigint, embedding array<double>, x int, deviation int"
    )
    found = whitening.whiten(df.repartition(7)).collect()
    compare(found, plain(good, 5))
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5}


def test_entries_beyond_the_limit_and_long_sums(spark):
    rows = [(i, [1e30 * (i % 2), float(i), -1e300 * (i % 3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    limit = whitening.LIMIT / 64
    cut = [(k, [max(-limit, min(limit, c)) for c in v]) for k, v in rows]
    compare(whitening.whiten(df).collect(), plain(cut, 2))  # the third is rounding error beside these


def test_fewer_components_than_asked_for(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert {r["component"] for r in whitening.whiten(df).collect()} == {1}
    assert whitening.whiten(df.filter("vec_id = 3")).collect() == []
    assert whitening.whiten(df.limit(0)).collect() == []


def test_squares_do_not_depend_on_their_width():
    rng = np.random.default_rng(1)
    small = rng.integers(-1000, 1000, (50, 6))
    large = small * (1 << 33)
    assert [int(a) << 66 for a in whitening._squares(small)] == [int(a) for a in whitening._squares(large)]
