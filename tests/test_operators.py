import math
import random
import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyflow.functions import columns as C
from skyflow.operators import features, filters, merge, outputs, parse, period, sky, training
from skyflow.sources import readers


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_position_numbers(spark):
    for ra, dec, want in ((0, 0, 1000000001000000000), (359, 0, 1235600001000000000), (312.12312311, 80.99999991, 1204829541805959900)):
        assert one(spark, C.aid_number(F.lit(float(ra)), F.lit(float(dec))))[0] == want
    a, b = (one(spark, C.aid_number(F.lit(float(r)), F.lit(-1.0)))[0] for r in (719, -1))
    assert a == b
    n = one(spark, C.aid_decode(C.aid_encode(F.lit(10**18 + 12345))))[0]
    assert n == 10**18 + 12345


def test_master_ids(spark):
    for oid in ("ZTF99zzzzzzz", "ZTF00aaaaaaa", "ZTF18abcdxyz"):
        survey, back = C.masterid_decode(C.masterid_encode(F.lit(oid)))
        assert tuple(one(spark, survey, back)) == ("ZTF", oid)
    assert one(spark, C.masterid_encode(F.lit("ZTF1Xabcdefg")))[0] is None


def test_dates_and_fluxes(spark):
    y, m, d = C.jd_to_date(F.lit(2446113.75))
    assert tuple(one(spark, y, m, d)) == (1985, 2, 17.25)
    mag, e = C.flux_to_mag(F.lit(-99999.0), F.lit(1.0), F.lit(26.0))
    assert tuple(one(spark, mag, e)) == (100.0, 100.0)


def haversine(a, b):
    (r1, d1), (r2, d2) = ((math.radians(x) for x in p) for p in (a, b))
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(h))))


@pytest.mark.parametrize("radius", [0.5, 3.0])
def test_sky_join_against_brute_force(spark, radius):
    r = random.Random(7)

    def points(n):
        out = [(r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1)))) for _ in range(n)]
        return out + [(float(r.choice([0, 0.01, 359.99, 180])), float(r.choice([-90, -89.9, 89.95, 90, 0]))) for _ in range(n // 3)]

    a, b = points(200), points(200)
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(a)], "i int, ra double, dec double")
    right = spark.createDataFrame([(j, *p) for j, p in enumerate(b)], "j int, ra double, dec double")
    got = sorted((x.i, x.j) for x in sky.sky_join(left, right, F.lit(radius), radius).collect())
    want = sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if haversine(p, q) <= radius)
    assert got == want and want


def test_filters_reject_unknown_trees():
    with pytest.raises(ValueError):
        filters.compile_filter({"type": "xor"})
    with pytest.raises(ValueError):
        filters.compile_filter('{"type": "constant", "params": {"field": "mag", "constant": 1, "op": "near"}}')


def test_keyed_table_rewrites_touched_partitions_only(spark, tmp_path):
    import os

    t = merge.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    assert t.read() is None
    a = spark.createDataFrame([(k, "x") for k in range(40)], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (2, "y"), (77, "w")], "k int, v string")
    t.merge(a)
    files = lambda: {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".parquet")}
    before = files()
    for _ in range(2):
        t.merge(b)
    assert len(set(before) & set(files())) >= len(before) - 2 and os.listdir(tmp_path) == ["t"]
    want = sorted([(k, "x") for k in range(40) if k != 2] + [(2, "z"), (77, "w")])
    assert sorted(map(tuple, t.read().collect())) == want
    t.merge(spark.createDataFrame([(1, "late")], "k int, v string"), "ignore")
    assert sorted(map(tuple, t.read().collect())) == want and t.read(b).count() < 42


ALERT = """schemavsn string, publisher string, objectId string, candid long,
 candidate struct<jd: double, fid: int, pid: long, isdiffpos: string, ra: double, dec: double, magpsf: double, sigmapsf: double>,
 prv_candidates array<struct<jd: double, fid: int, candid: long, isdiffpos: string, ra: double, dec: double, magpsf: double, sigmapsf: double, diffmaglim: double>>,
 fp_hists array<struct<jd: double, fid: int, pid: long, forcediffimflux: double, forcediffimfluxunc: double, magzpsci: double, procstatus: string>>"""


def alerts(spark):
    p = [(2450001.5, 1, 7, "t", 10.0, 5.0, 18.0, 0.1, 19.0), (2450002.5, 2, None, None, None, None, None, None, 20.5)]
    f = [(2450003.5, 1, 9, 100.0, 10.0, 26.0, "0"), (2450003.6, 1, 10, -99999.0, 10.0, 26.0, "0")]
    return spark.createDataFrame([("3", "ZTF broker", "ZTF18abcdxyz", 5, (2450004.5, 2, 3, "f", 11.0, 60.0, 17.0, 0.2), p, f)], ALERT)


def test_alerts_flatten(spark):
    a = alerts(spark)
    det = parse.standardize_ztf(a).first()
    assert (det.mjd, det.fid, det.isdiffpos, round(det.e_ra, 6), det.e_dec) == (50004.0, "r", -1, 0.17, 0.085)
    assert [(x.candid, x.fid, x.isdiffpos, x.parent_candid) for x in parse.explode_previous(a).collect()] == [("7", "g", 1, "5")]
    assert [(x.fid, x.mjd, x.diffmaglim) for x in parse.explode_limits(a).collect()] == [("r", 50002.0, 20.5)]
    forced = parse.explode_forced(a).collect()
    assert [(x.candid, x.forced, x.ra) for x in forced] == [("ZTF18abcdxyz9", True, 11.0)] and abs(forced[0].mag - (-2.5 * math.log10(100 * 10 ** ((8.9 - 26) / 2.5) * 1e6) + 23.9)) < 1e-9
    routed = parse.route_survey(a, {"ztf": (F.col("publisher").contains("ZTF"), parse.standardize_ztf)})
    assert routed.count() == 1
    with pytest.raises(PySparkException):
        parse.route_survey(a, {"atlas": (F.col("publisher").contains("ATLAS"), parse.standardize_ztf)}).collect()


def test_period_of_a_sine(spark):
    r = random.Random(1)
    t = sorted(r.uniform(0, 60) for _ in range(120))
    rows = [("a", k, b, x, 15 + math.sin(2 * math.pi * x / 0.5388) + r.gauss(0, 0.05), 0.05, False) for k, x in enumerate(t) for b in ("g",)]
    det = spark.createDataFrame(rows, "oid string, candid long, fid string, mjd double, mag double, e_mag double, forced boolean")
    grid = period.frequency_grid(det, 0.2, 5.0, least=1500)
    power = period.multiband(period.mhaov(det, grid))
    assert abs(period.period_features(power).first().period - 0.5388) < 0.01
    bands = period.mhaov(det, grid)
    refined, by_band = period.refine(det, grid, bands)
    fine = period.period_features(refined).first()
    coarse, better = ({r.k: r.power for r in x.collect()} for x in (power, refined))
    assert coarse.keys() == better.keys() and sum(better[k] != coarse[k] for k in coarse) <= 10 and all(better[k] >= coarse[k] for k in coarse)
    assert period.band_periods(by_band, period.period_features(refined)).first().delta_period < 1e-9
    assert abs(fine.period - 0.5388) < 0.002
    per = spark.createDataFrame([("a", 0.5388)], "oid string, period double")
    h = features.harmonics(det, per, 3).first()
    assert abs(h.Harmonics_mag_1 - 1) < 0.05 and h.Harmonics_mag_2 < 0.05


def test_sources(spark, tmp_path):
    assert [r.topic for r in readers.daily_topics(spark, "alerts_%s", "2024-03-01 23:30:00", 22, 2).collect()] == ["alerts_20240229", "alerts_20240301", "alerts_20240302"]
    df = spark.createDataFrame([(1, "ztf_x"), (123, "ztf_y")], "candid long, topic string")
    assert [r.key for r in readers.stamp_objects(df, {"ztf": "bucket"}).collect()] == ["1.avro", "321.avro"]
    with pytest.raises(PySparkException):
        readers.stamp_objects(df, {"atlas": "b"}).collect()
    enc = readers.encode_value(df)
    assert sorted(map(tuple, readers.decode_value(enc, "candid long, topic string").collect())) == sorted(map(tuple, df.collect()))
    assert {(r.key, r["topic"]) for r in readers.keyed_records(df.select("candid"), "candid", ["a", "b"]).collect()} == {("1", "a"), ("1", "b"), ("123", "a"), ("123", "b")}
    readers.archive_alerts(spark.createDataFrame([(2460310.5, 1), (2460311.4, 2)], "jd double, x int"), str(tmp_path / "arch"))
    assert {str(r.date) for r in spark.read.parquet(str(tmp_path / "arch")).collect()} == {"2024-01-01"}


def curve(spark, f, n=60, fid="g", seed=3, e=0.05):
    r = random.Random(seed)
    t = sorted(r.uniform(0, 50) for _ in range(n))
    rows = [("a", k, fid, x, f(x, r), e, False, 1) for k, x in enumerate(t)]
    return spark.createDataFrame(rows, "oid string, candid long, fid string, mjd double, mag double, e_mag double, forced boolean, isdiffpos int"), [(x[3], x[4]) for x in rows]


def test_random_walk_likelihood_against_a_loop(spark):
    from skyflow.operators import fits

    det, pts = curve(spark, lambda x, r: 17 + r.gauss(0, 0.3))
    got = fits.fit_drw(det, [0.2, 0.4], [1.0, 5.0], refine=False).first()
    mean = sum(m for _, m in pts) / len(pts)
    best = None
    for s in (0.2, 0.4):
        for tau in (1.0, 5.0):
            x, p, last, nll = 0.0, s * s, None, 0.0
            for t, m in pts:
                a = 0.0 if last is None else math.exp(-(t - last) / tau)
                x, p = a * x, a * a * p + s * s * (1 - a * a)
                q = p + 0.05**2
                d = m - mean - x
                nll += 0.5 * (math.log(q) + d * d / q)
                x, p, last = x + p / q * d, p * (1 - p / q), t
            best = min(best or (math.inf, 0, 0), (nll, s, tau))
    assert abs(got.GP_DRW_nll - best[0]) < 1e-6 and (got.GP_DRW_sigma, got.GP_DRW_tau) == best[1:]


def test_autocorrelation_and_pvar(spark):
    from skyflow.operators import variability as v

    det, pts = curve(spark, lambda x, r: 17 + math.sin(x / 5) + r.gauss(0, 0.05))
    m = [y for _, y in pts]
    mean = sum(m) / len(m)
    z = [y - mean for y in m]
    c0 = sum(x * x for x in z)
    want = next(k for k in range(1, len(z)) if sum(a * b for a, b in zip(z, z[k:])) < c0 / math.e)
    assert v.autocor_length(det).first().Autocor_length == want
    x = one(spark, v.chi2_tail(F.lit(10.0), F.lit(10.0)), v.chi2_tail(F.lit(3.84), F.lit(1.0)), v.chi2_tail(F.lit(30.0), F.lit(20.0)))
    assert abs(x[0] - 0.559507) < 2e-4 and abs(x[1] - 0.949957) < 1e-4 and abs(x[2] - 0.930146) < 2e-4
    assert v.pvar(det).first().Pvar > 0.99


def test_heliocentric_times_stay_within_the_light_time(spark):
    from skyflow.operators import variability as v

    det, _ = curve(spark, lambda x, r: 17.0)
    d = v.helio_correct(det.withColumns({"ra": F.lit(266.0), "dec": F.lit(-23.0), "mjd": F.col("mjd") + 60000})).collect()
    assert max(abs(r.mjd - r.mjd_original) for r in d) < 0.00586


def test_fits_recover_grid_values(spark):
    from skyflow.operators import fits

    det, pts = curve(spark, lambda x, r: 20 - 2.5 * math.log10(1 + ((u := 0.09 + ((x - 25) / 5) ** 2) + 2) / math.sqrt(u * (u + 4)) - 1) + r.gauss(0, 0.005), e=0.01)
    m = fits.fit_microlensing(det, [0.1, 0.3, 0.6], [2.0, 5.0, 10.0], refine=False).first()
    assert (m.ulens_u0, m.ulens_tE) == (0.3, 5.0)
    m = fits.fit_microlensing(det).first()
    assert abs(m.ulens_u0 - 0.3) < 0.05 and abs(m.ulens_tE - 5) < 0.5 and abs(m.ulens_t0 - 25 + min(t for t, _ in pts)) < 0.1
    assert fits.fit_fleet(det).count() == 1 and fits.fit_supernova(det).first().SPM_chi >= 0


def test_mutual_information_peaks_at_the_period(spark):
    det, pts = curve(spark, lambda x, r: 17 + math.sin(2 * math.pi * x / 2.5) + r.gauss(0, 0.05), n=50)
    grid = spark.createDataFrame([("a", 0, k, f) for k, f in enumerate((0.11, 0.23, 0.4, 0.57))], "oid string, block int, k int, freq double")
    for mode, kernel in (("cauchy_schwarz", "gaussian"), ("euclidean", "gaussian"), ("cauchy_schwarz", "cauchy")):
        got = {r.k: r.power for r in period.qmi(det, grid, mode, kernel=kernel).collect()}
        assert max(got, key=got.get) == 2
    assert len(period.qmi(det, grid, "entropy").collect()) == 4


def test_simulated_survey_history(spark):
    src = "struct<diaSourceId: long, diaObjectId: long, midPointTai: double, filterName: string, ra: double, decl: double, psFlux: double, psFluxErr: double>"
    forced = "struct<diaForcedSourceId: long, diaObjectId: long, midPointTai: double, filterName: string, psFlux: double, psFluxErr: double>"
    s = (7, 5, 60000.0, "g", 1.0, 2.0, -3.0, 0.1)
    a = spark.createDataFrame([(1, s, [s], [(9, 5, 60001.0, "r", 4.0, 0.2)]), (2, s, None, None)], f"alertId long, diaSource {src}, prvDiaSources array<{src}>, prvDiaForcedSources array<{forced}>")
    got = sorted((r.candid, r.forced, r.isdiffpos, r.ra) for r in parse.explode_lsst(a).collect())
    assert got == [("7", False, -1, 1.0), ("9", True, 1, 1.0)]


def test_harmonic_powers_against_least_squares(spark):
    det, pts = curve(spark, lambda x, r: 17 + math.sin(2 * math.pi * x / 3) + 0.4 * math.cos(4 * math.pi * x / 3) + r.gauss(0, 0.1), n=40)
    t0 = min(t for t, _ in pts)
    y = np.array([m for _, m in pts])
    for h in (1, 2, 3):
        grid = period.frequency_grid(det, 1.0, 10.0, least=20)
        got = period.mhaov(det, grid, h).collect()
        for r in got[::7]:
            phase = 2 * np.pi * np.array([(t - t0) * r.freq for t, _ in pts])
            x = np.column_stack([np.ones(len(y))] + [f(k * phase) for k in range(1, h + 1) for f in (np.cos, np.sin)]) / 0.05
            fit = np.linalg.lstsq(x, y / 0.05, rcond=None)[0]
            total, rest = np.sum(((y - y.mean()) / 0.05) ** 2), np.sum((y / 0.05 - x @ fit) ** 2)
            assert abs(r.power - (total - rest)) < 1e-6 * total and abs(r.ratio - (40 - 2 * h - 1) / (2 * h) * (total - rest) / rest) < 1e-4 * r.ratio + 1e-6


def test_structure_function_indices_against_a_loop(spark):
    det, pts = curve(spark, lambda x, r: 17 + math.sin(x / 4) + r.gauss(0, 0.05), n=30)
    t, m = (np.array(x) for x in zip(*pts))
    c = np.interp(np.linspace(t.min(), t.max(), 100), t, m)
    y = [np.log10([np.mean(np.abs(c[:-k] - c[k:]) ** p) for k in range(1, 100)]) for p in (1, 2, 3)]
    got = features.structure_function_indices(det).first()
    for name, a, b in (("21", 0, 1), ("31", 0, 2), ("32", 1, 2)):
        assert abs(got[f"StructureFunction_index_{name}"] - np.polyfit(y[a], y[b], 1)[0]) < 1e-6


def test_sequences_against_a_loop(spark):
    det, pts = curve(spark, lambda x, r: 17.0 + x / 100, n=30)
    times = [t for t, _ in pts]

    def nearest(times, marks):
        free, got = list(times), []
        for m in marks:
            if free:
                got.append(min(free, key=lambda t: (abs(t - m), t)))
                free.remove(got[-1])
        return sorted(got)

    marks = [times[0] + 40 ** (j / 7) for j in range(8)]
    assert [x for x in training.sequence_sample(det, 8, "log_time", 40.0).first().time] == nearest(times, marks)
    late = det.withColumn("forced", F.col("mjd") < times[12])
    early = [times[j * 11 // 2] for j in range(3)]
    marks = [times[12] + 0.5 * 80 ** (j / 4) for j in range(5)]
    assert training.sequence_sample(late, 8, "linear_log_time", 40.0, 3).first().time == sorted(early + nearest(times[12:], marks))
    idx = sorted({round(30 ** (j / 7) - 1) for j in range(8)})
    got = training.sequence_sample(det, 8, "log_index").first()
    assert got.time == [times[k] for k in idx] + [0.0] * (8 - len(idx)) and sum(got["mask"]) == len(idx)
    assert training.sequence_sample(det, 8, "windows").count() == 0 and training.sequence_sample(det, 40, "windows").first()["mask"] == [1] * 30 + [0] * 10


def test_quantile_transform_and_metadata(spark):
    vals = [float(x * x) for x in range(101)] + [0.0] * 30
    df = spark.createDataFrame([("f", v) for v in vals], "name string, v double")
    q = training.feature_quantiles(df, "name", "v", 20)
    edges = np.quantile(vals, np.linspace(0, 1, 21))
    for r in training.quantile_transform(df, q, "name", "v", 20).distinct().collect():
        place = np.linspace(0, 1, 21)
        want = (np.interp(r.v, edges, place) - np.interp(-r.v, -edges[::-1], -place[::-1])) / 2
        assert abs(r.uniform - want) < 1e-9
    md = spark.createDataFrame([("a", "1.5"), ("b", "x"), ("c", None), ("d", "NaN"), ("e", "9")], "oid string, m string")
    parts = spark.createDataFrame([("a", "train"), ("e", "train"), ("b", "test")], "oid string, partition string")
    got = {r.oid: (r.value, r.uniform) for r in training.metadata_quantiles(md, parts, ["m"]).collect()}
    assert got == {"a": (1.5, 0.0), "b": (-9999.0, 0.0), "c": (-9999.0, 0.0), "d": (-9999.0, 0.0), "e": (9.0, 1.0)}


def test_ranks_splits_and_resampled_positions(spark):
    rows = [(k, "big" if k % 10 else "small", float(k % 7 - 3)) for k in range(300)]
    df = spark.createDataFrame(rows, "oid long, label string, dec double")
    folds = training.stratified_kfold(df, 7).groupBy("label", "fold").count().collect()
    for name, n in (("big", 270), ("small", 30)):
        assert sorted(r["count"] for r in folds if r.label == name) == sorted([n // 7 + (k < n % 7) for k in range(7)])
    parts = training.partitions(df, 5)
    assert parts.count() == 300 and parts.filter("blind_label = 'unknown'").count() == 60 and {r.class_id for r in parts.select("class_id").distinct().collect()} == {0, 1}
    out = outputs.debias_positions(df.withColumn("z", F.col("dec")), "label", "big", 10, resampled=["dec"])
    assert out.count() == 300 and out.filter("label = 'big' and dec < 0").count() < 40 and outputs.debias_positions(df, "label", "big", 10).filter("label = 'big' and dec < 0").count() == 10


def test_added_features_statistics_classifiers_and_strategies(spark):
    from skyflow.operators import classify, feature_sets, stats

    det, pts = curve(spark, lambda x, r: 17 + r.gauss(0, 0.1), n=20)
    features.register_feature("Above", lambda level=17.0: F.sum((F.col("mag") > level).cast("double")))
    assert features.basic_features(det, ["Above"], {"Above": {"level": 0.0}}).first().Above == 20
    with pytest.raises(ValueError):
        features.basic_features(det, ["nothing"])
    stats.register_statistic("spread", lambda: F.max("mag") - F.min("mag"))
    rows = det.withColumns({"sid": F.lit("ztf"), "mag_corr": F.col("mag"), "corrected": F.lit(True), "stellar": F.lit(True), "dubious": F.lit(False)})
    assert stats.generate_statistics(rows, only={"spread"}).first().spread > 0
    feature_sets.register_extractor("n", lambda x: feature_sets.long(x.obs.groupBy("oid").agg(F.count("*").alias("n")), ["oid"]))
    feature_sets.register_set("mine", ["n", "reference"])
    assert [tuple(r) for r in feature_sets.feature_set(det, "mine", ["g"]).collect()] == [("a", "", "n", 20.0, "1.0.0")]
    classify.register_classifier("even", lambda f: f.select("oid"), lambda x: x.select("oid", F.explode(F.map_from_arrays(F.array(F.lit("A"), F.lit("B")), F.array(F.lit(0.4), F.lit(0.6)))).alias("class_name", "probability")))
    assert [(r.class_name, r.ranking) for r in classify.classify("even", det.select("oid").distinct()).orderBy("ranking").collect()] == [("B", 1), ("A", 2)]
    outputs.WATCHLIST_STRATEGIES["none"] = lambda m, fields: m.withColumn("values", F.lit("{}"))
    assert outputs.watchlist_values(det, ["mag"], "none").first()["values"] == "{}"


def test_small_sources_and_outputs(spark, tmp_path):
    from skyflow.operators import ingest

    df = spark.createDataFrame([(1, "a", 2460310.5), (2, None, 2460311.6)], "candid long, topic string, jd double")
    stamped = ingest.stamp_ingest_time(df).collect()
    assert [r.topic for r in stamped] == ["a", ""] and stamped[0].brokerIngestTimestamp > 1.6e9
    assert ingest.passthrough_alert(df).first().non_detections == []
    shapes = spark.createDataFrame([(63, 63), (62, 63), (None, 63)], "stamp_rows int, stamp_columns int")
    assert ingest.stamp_shape_ok(shapes).count() == 1
    assert ingest.column_profile(df.withColumnsRenamed({"topic": "fid"}), "batch", ["time", "band"]).columns == ["time", "band"]
    readers.archive_alerts(df, str(tmp_path / "a"), survey="ztf")
    assert sorted(x.name for x in (tmp_path / "a").iterdir()) == ["ztf_20240101", "ztf_20240102"]
    rec = spark.createDataFrame([(b"k", b"v", "old")], "key binary, value binary, topic string")
    assert readers.mirror_topic(rec, False, False, "new").first().topic == "new" and readers.mirror_topic(rec, False).first().topic == "old"
    readers.write_metrics(df, str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).count() == 2
    readers.to_config(df, {"kind": "json", "path": str(tmp_path / "j")})
    assert readers.from_config(spark, {"kind": "json", "path": str(tmp_path / "j")}).count() == 2
    readers.SOURCES["mine"] = lambda spark, path, **o: spark.range(3)
    assert readers.from_config(spark, {"kind": "mine"}).count() == 3
    import re

    assert re.fullmatch(readers.topic_pattern("ztf.%s_x"), "ztf.20240131_x") and not re.fullmatch(readers.topic_pattern("ztf.%s_x"), "ztf-20240131_x")
    readers.write_csv(df, str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c"), "candid long, topic string, jd double", header=False).count() == 2
    (tmp_path / "x.json").write_text('[{"a": 1}, {"a": 2}]')
    assert readers.read_json_array(spark, str(tmp_path / "x.json")).count() == 2


def test_command_stage_applies_and_counts(spark, tmp_path):
    from skyflow.streaming.stages import command_stage

    t = merge.KeyedTable(spark, str(tmp_path / "d"), ["oid", "fid", "mjd"], ["oid"], 4)
    t.merge(spark.createDataFrame([("a", 1, 1.0, 20.0), ("b", 2, 1.0, 20.0)], "oid string, fid int, mjd double, diffmaglim double"))
    rows = spark.createDataFrame([("a", "g", 1.0, 21.0), ("a", "g", 1.0, 22.0), ("c", "r", 3.0, 19.0)], "oid string, fid string, mjd double, diffmaglim double")
    good = merge.command_rows(rows, "non_detection", "update", ["oid", "fid", "mjd"], ["diffmaglim"])
    bad = merge.command_rows(rows, "nothing", "update", ["oid"], ["mjd"])
    batch = good.unionByName(bad).withColumn("seq", F.monotonically_increasing_id())
    counted = []
    stage = command_stage({"non_detection": t}, lambda m: counted.extend(m.collect()))
    for n in range(2):  # a replay changes nothing
        stage(batch, n)
        got = sorted(map(tuple, t.read().select("oid", "fid", "mjd", "diffmaglim").collect()))
        assert got == [("a", 1, 1.0, 22.0), ("b", 2, 1.0, 20.0), ("c", 2, 3.0, 19.0)]
    assert [r.n for r in counted] == [3, 3]


def test_command_stage_on_tables_never_written(spark, tmp_path):
    """The first batch inserts an object and updates it, in either order, and only its partitions are written."""
    from skyflow.streaming.stages import command_stage

    schema = "oid string, ndet long, firstmjd double, lastmjd double, meanra double, corrected boolean, stellar boolean"
    table = merge.KeyedTable(spark, str(tmp_path / "o"), ["oid"], ["oid"], 16, schema)
    assert table.read().count() == 0
    stage = command_stage({"object": table})
    rows = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 11.0)], "oid string, ndet long, firstmjd double")
    insert = merge.command_rows(rows, "object", "insert", ["oid"], ["ndet", "firstmjd"]).withColumn("seq", F.lit(2))
    update = merge.command_rows(rows.withColumn("ndet", F.lit(7)), "object", "update", ["oid"], ["ndet"]).withColumn("seq", F.lit(1))
    for n in range(2):
        stage(update.unionByName(insert), n)
        assert sorted((r.oid, r.ndet) for r in table.read().collect()) == [("a", 7), ("b", 7)]
    with pytest.raises(ValueError, match="never written"):
        command_stage({"object": merge.KeyedTable(spark, str(tmp_path / "p"), ["oid"])})(insert, 0)


def test_a_merge_stopped_halfway_leaves_the_table(spark, tmp_path, monkeypatch):
    import os

    t = merge.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    t.merge(spark.createDataFrame([(k, "x") for k in range(20)], "k int, v string"))
    want = sorted(map(tuple, t.read().collect()))
    new = spark.createDataFrame([(k, "y") for k in range(10, 30)], "k int, v string")

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(merge.KeyedTable, "_commit", stop)
        with pytest.raises(RuntimeError, match="lost"):
            t.merge(new)
    assert sorted(map(tuple, t.read().collect())) == want
    reader = t.read()  # under way while the table changes
    t.merge(new)
    assert sorted(map(tuple, reader.collect())) == want
    assert sorted(map(tuple, t.read().collect())) == [(k, "x") for k in range(10)] + [(k, "y") for k in range(10, 30)]
    t.merge(spark.createDataFrame([(99, "z", 1)], "k int, v string, more int"))  # a new column is null in old partitions
    assert {r.more for r in t.read().collect()} == {None, 1}
    for k in range(5):
        t.merge(spark.createDataFrame([(k, "w", k)], "k int, v string, more int"))
    assert t.read().count() == 31 and sum(f.startswith("manifest-") for f in os.listdir(tmp_path / "t")) == 2


def test_precision_and_recall_over_ranges(spark, monkeypatch):
    from skyflow.operators import training

    monkeypatch.setattr(training, "RANGES", 7)
    r = random.Random(6)
    rows = [(r.choice([r.random(), round(r.random(), 1), 0.5]), r.random() < 0.3) for _ in range(800)] + [(None, True), (0.25, None)]
    got = sorted(tuple(x) for x in training.precision_recall_curve(spark.createDataFrame(rows, "score double, hit boolean"), "score", "hit").collect())
    scored = [(s, bool(h)) for s, h in rows if s is not None]
    want = []
    for s in sorted({s for s, _ in scored}):
        said = [h for x, h in scored if x >= s]
        want.append((s, sum(said) / len(said), sum(said) / sum(h for _, h in scored)))
    assert [x[0] for x in got] == [x[0] for x in want] and np.allclose(got, want)
    assert training.precision_recall_curve(spark.createDataFrame([(0.5, False)], "score double, hit boolean"), "score", "hit").first().recall is None
    plan = training.precision_recall_curve(spark.createDataFrame(rows, "score double, hit boolean"), "score", "hit")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and not re.search(r"windowspecdefinition\((?!__r)", plan)


def test_sketches_of_batches_within_their_error(spark):
    from skyflow.operators import training

    r = random.Random(7)
    batches = [[(n, r.gauss(k, 1) if n == "a" else r.random() ** 3) for n in "ab" for _ in range(6000)] + [("a", None), ("b", float("nan"))] for k in range(4)]
    parts = [training.feature_sketches(spark.createDataFrame(b, "name string, v double").repartition(3), "name", "v") for b in batches]
    got = training.sketch_quantiles(training.merge_sketches(*parts), steps=20).collect()
    assert len(got) == 42 and max(len(bytes(x.sketch)) for x in training.merge_sketches(*parts).collect()) < 40_000
    for n in "ab":
        values = np.sort([v for b in batches for m, v in b if m == n and v is not None and v == v])
        for x in [x for x in got if x.name == n]:
            low, high = np.searchsorted(values, x.quantile, "left") / len(values), np.searchsorted(values, x.quantile, "right") / len(values)
            assert low - 0.011 <= x.step / 20 <= high + 0.011


def test_forest_scores_are_products_of_levels(spark):
    r = random.Random(3)
    rows = [(k % 3, f"{'AB'[k % 3 // 2]}", f"{'AB'[k % 3 // 2]}{k % 3}", k % 3 + r.gauss(0, 0.1), r.random()) for k in range(300)]
    df = spark.createDataFrame(rows, "oid long, top string, child string, x double, y double")
    predict = outputs.hierarchical_forest(df, "top", "child", ["x", "y"], trees=10, depth=3)
    got = predict(df).collect()
    names = ["A0", "A1", "B2"]
    assert all(abs(sum(g[n] for n in names) - 1) < 1e-9 and min(g[n] for n in names) >= 0 for g in got)
    assert sum(max(names, key=lambda n: g[n]) == g.child for g in got) > 290


def test_chi_square_column_far_out(spark):
    from skyflow.operators import variability as v

    x = one(spark, v.chi2_tail(F.lit(4000.0), F.lit(12.0)), v.chi2_tail(F.lit(0.0), F.lit(3.0)))
    assert (x[0], x[1]) == (1.0, 0.0)
