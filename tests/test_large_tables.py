"""What small tables do not show: ties, names that come again, tables that do not come out the same twice."""

import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyflow.functions import columns as C
from skyflow.operators import commands, features, fits, least_squares, period
from skyflow.operators.feature_kernel import Segments
from skyflow.plans import driver_tables as T
from skyflow.plans.catalog import QUERIES


def test_quantiles_of_ties_are_the_tied_value(spark):
    r = random.Random(3)
    # the lowest two magnitudes of each curve are alike, and so are the highest two
    curves = {f"c{k}": [x := round(r.uniform(14, 16), 3) + 1 / 3, x, y := round(r.uniform(19, 21), 3) + 1 / 3, y, *(r.uniform(16, 19) for _ in range(8 + k % 9))] for k in range(60)}
    rows = [(o, i, "g", float(i), m, 0.1, False) for o, ms in curves.items() for i, m in enumerate(ms)]
    det = spark.createDataFrame(rows, "oid string, candid long, fid string, mjd double, mag double, e_mag double, forced boolean")
    for x in features.basic_features(det, ["Gskew"]).collect():
        m = curves[x.oid]
        assert abs(x.Gskew - (min(m) + max(m) - 2 * np.median(m))) < 1e-9, x.oid


def test_names_of_many_users_do_not_come_again(spark, tmp_path):
    users = [0, 67_599, 67_600, 67_600 + 26, 135_200, 67_600 * 26, 67_600 * 26 + 1, 67_600 * 26**4 + 3]
    e = spark.createDataFrame([(k, u) for k, u in enumerate(users)], "event_id long, user_id long")
    e = e.select("event_id", F.current_timestamp().alias("ts"), "user_id", F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"))
    e.write.parquet(f"{tmp_path}/events.parquet")
    own = T.alerts(spark, str(tmp_path), distinct=True).select("objectId", C.masterid_encode(F.col("objectId")).alias("id")).collect()
    assert len({x.objectId for x in own}) == len({x.id for x in own}) == len(users) and None not in {x.id for x in own}
    first = [T.alerts(spark, str(tmp_path), x).filter("candid < 2").orderBy("candid").select("objectId").collect() for x in (False, True)]
    assert first[0] == first[1]  # small tables keep their names


def test_keyed_writes_read_a_table_once(spark):
    def some(batches):  # each time that it is read, every object has one of two classes
        for b in batches:
            yield pd.DataFrame({"oid": b["oid"], "detector_name": "d", "detector_version": "1", "category_name": np.random.default_rng().choice(["a", "b"], len(b)), "score": 0.0})

    kinds = "oid string, detector_name string, detector_version string, category_name string, score double"
    objects = spark.range(200).select(F.col("id").cast("string").alias("oid"))
    new = objects.withColumn("category_name", F.explode(F.array(F.lit("a"), F.lit("b")))).select("oid", F.lit("d").alias("detector_name"), F.lit("1").alias("detector_version"), "category_name", F.lit(1.0).alias("score"), F.lit(1).alias("seq"))
    out = commands.set_columns(objects.mapInPandas(some, kinds), new, ["oid", "detector_name", "detector_version", "category_name"], ["score"])
    rows = out.collect()
    assert out.columns == ["oid", "detector_name", "detector_version", "category_name", "score"]
    assert sorted((x.oid, x.category_name, x.score) for x in rows) == sorted((str(k), c, 1.0) for k in range(200) for c in "ab")


def test_complex_autoregression_against_a_loop(spark):
    r, axis = random.Random(8), [-0.9, -0.6, -0.3, 0.1, 0.3, 0.6, 0.9, 0.99]
    curves = {f"c{k}": sorted((round(r.uniform(0, 30), 3), r.gauss(16, 1)) for _ in range(n)) for k, n in enumerate([6, 31, 7, 120, 6, 15])}
    rows = [(o, i, "g", t, m, 0.1, False) for o, c in curves.items() for i, (t, m) in enumerate(c)] + [("flat", i, "g", float(i), 15.1, 0.1, False) for i in range(9)] + [("few", i, "g", float(i), 15.0 + i, 0.1, False) for i in range(5)]
    rows += [("c1", 99, "g", None, None, 0.1, False), ("c2", 99, "g", 40.0, None, 0.1, False)]  # points without a magnitude count for nothing
    det = spark.createDataFrame(rows, "oid string, candid long, fid string, mjd double, mag double, e_mag double, forced boolean")

    def cost(t, z, phi):
        x, p, total = np.zeros(2), np.eye(2), 0.0
        for i in range(len(t)):
            f = phi ** (t[i] - t[i - 1]) if i else 0.0
            f = np.array([[np.real(f), -np.imag(f)], [np.imag(f), np.real(f)]])
            x, p = f @ x, f @ p @ f.T + (1 - f[0, 0] ** 2 - f[1, 0] ** 2) * np.eye(2)
            e, v = z[i] - x[0], p[0, 0]
            total += (np.log(v) + e * e / v) / 2
            x, p = x + p[:, 0] * e / v, p - np.outer(p[:, 0], p[:, 0]) / v
        return round(total, 9)

    got = {x.oid: (x.CIAR_phiR, x.CIAR_phiI) for x in fits.fit_ciar(det).collect()}
    assert set(got) == set(curves)
    for o, c in curves.items():
        t, m = map(np.array, zip(*c))
        z = (m - m.mean()) / m.std(ddof=1)
        assert got[o] == min((cost(t, z, complex(a, b)), a, b) for a in axis for b in axis if a * a + b * b < 1)[1:], o
    # a table of 15,000 points is fitted within seconds
    many = det.filter("oid = 'c5'").crossJoin(spark.range(1000)).withColumn("oid", F.concat("oid", F.col("id").cast("string"))).drop("id")
    began = time.time()
    assert fits.fit_ciar(many).filter(F.col("CIAR_phiR") == got["c5"][0]).count() == 1000 and time.time() - began < 20


@pytest.mark.parametrize("cells", [1 << 20, 1 << 11])
def test_whole_objects_have_the_periods_of_rows(spark, monkeypatch, cells):
    r, rows = random.Random(4), []
    for o in range(8):
        for i in range((12, 40, 90)[o % 3]):
            t = r.uniform(0, 3 + o)
            rows.append((f"o{o}", i, r.choice("gri"[: 1 + o % 3]), t, 15 + math.sin(2 * math.pi * t / (0.3 + 0.2 * o)) + r.gauss(0, 0.1), 0.0 if o == 6 else r.choice([0.05, 0.1]), i % 11 == 0))
    rows += [("o1", 99, "z", 1.0, 15.0, 0.0, False), ("one", 1, "g", 5.0, 15.0, 0.1, False), ("flat", 1, "g", 5.0, 15.0, 0.1, False), ("flat", 2, "g", 6.0, 15.0, 0.1, False)]
    det = spark.createDataFrame(rows, "oid string, candid long, fid string, mjd double, mag double, e_mag double, forced boolean")
    spec = period.frequency_spec(det, 0.1, 10.0, least=300)
    for peaks in (0, 10):
        power, bands = (period.refine(det, spec, period.mhaov(det, spec), peaks) if peaks else (period.mhaov_multiband(det, spec), period.mhaov(det, spec)))
        best = {x.oid: x for x in period.period_features(power).collect()}
        rates = {(x.oid, x.name): x.rate for x in period.power_rates(power).collect()}
        by_band = {(x.oid, x.fid): x.Period_band for x in period.band_periods(bands, period.period_features(power)).collect()}
        monkeypatch.setattr(period, "CELLS", cells)
        found = period.object_periods(det, spec, peaks=peaks)
        got = found.collect()
        assert {x.oid for x in got} == set(best) and "o6" not in best and {"one", "flat"} <= set(best)
        for x in got:
            assert (x.period, x.peak, x.ppe) == pytest.approx((best[x.oid].period, best[x.oid].peak, best[x.oid].ppe), rel=1e-8)
            plain = lambda rs: [math.nan if y is None else y for y in rs]
            assert plain(x.rates) == pytest.approx(plain(rates[x.oid, name] for _, name in period.RATES), rel=1e-6, nan_ok=True)
        assert {(x.oid, x.fid): x.Period_band for x in period.each_band(found).collect()} == pytest.approx(by_band, rel=1e-8)


@pytest.mark.parametrize("name", ["refined_periods", "band_periods"])
def test_periods_are_found_in_one_search(spark, name):
    """No row for each frequency leaves the search, and objects are searched once."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_random_walks_of_many_curves_are_those_of_each(monkeypatch):
    r = np.random.default_rng(2)
    n = r.integers(5, 25, 2000)
    s, rows = Segments(np.cumsum(n) - n, int(n.sum())), int(n.sum())
    t, m, e = np.concatenate([np.sort(r.uniform(0, 30, k)) for k in n]), r.normal(0, 1, rows), r.uniform(0, 0.1, rows)
    sigmas, taus = np.array([0.05, 0.1, 0.2, 0.4, 0.8, 1.6]), np.array([0.3, 1.0, 3.0, 10.0, 30.0, 100.0])
    began = time.time()
    found = least_squares.fit_walks(t, m, e, s, sigmas, taus)
    assert time.time() - began < 5  # one curve after the other took 8 ms each
    monkeypatch.setattr(least_squares, "WALK_CELLS", 1)
    for k in range(0, 2000, 200):
        own = slice(s.starts[k], s.starts[k] + n[k])
        assert found[k] == pytest.approx(least_squares.fit_walks(t[own], m[own], e[own], Segments(np.zeros(1, int), int(n[k])), sigmas, taus)[0], rel=1e-9)
        assert found[k][2] == pytest.approx(least_squares.walk_cost(t[own], m[own], e[own], found[k][:1], found[k][1:2])[0])
        assert found[k][2] <= min(least_squares.walk_cost(t[own], m[own], e[own], np.repeat(sigmas, 6), np.tile(taus, 6))) + 1e-12


def test_structure_function_indices_take_many_curves_at_once(spark):
    det = spark.createDataFrame([], "oid string, candid long, fid string, mjd double, mag double, e_mag double, forced boolean")
    plan = features.structure_function_indices(det)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "zip_with" not in plan
