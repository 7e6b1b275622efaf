"""Interval and detector operators against brute force on random data with ties."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from spanforge import timing
from spanforge.config import ConfigError, DeviationConfig, RegionConfig, config_hash, fingerprint, resolve
from spanforge.operators import detect, fuse, intervals, labels, ontology, robust, summarize
from spanforge.schema import DataError, check_frames


def rnd(seed):
    return random.Random(seed)


def brute_runs(flags):
    out, start = [], None
    for i, x in enumerate([*flags, False]):
        if x and start is None:
            start = i
        elif not x and start is not None:
            out.append((start, i))
            start = None
    return out


def frames(spark, per_key):
    rows = [(k, i, v) for k, vs in per_key.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "k string, frame_idx int, value double")


def test_timing_rules():
    assert timing.seed_frames(1.0, 0.25) == 4 and timing.min_event_frames(2.0, 0.25) == 9
    assert timing.merge_gap_frames(0.625, 0.25) == 2 and timing.merge_gap_frames(0.875, 0.25) == 4
    assert timing.class_min_frames(1.0, 0.25) == 4 and timing.closing_gap_frames(0.99, 0.25) == 3


def test_runs_and_closing(spark):
    r = rnd(1)
    data = {f"k{j}": [r.choice([0.0, 1.0, 1.0]) for _ in range(60)] for j in range(6)}
    f = frames(spark, data).withColumn("on", F.col("value") > 0)
    got = {(x.k, x.fs, x.fe) for x in intervals.runs(f, ["k"], "on").collect()}
    assert got == {(k, a, b) for k, v in data.items() for a, b in brute_runs([x > 0 for x in v])}
    valid = {k: [r.random() < 0.9 for _ in v] for k, v in data.items()}
    g = spark.createDataFrame([(k, i, valid[k][i], data[k][i] > 0 and valid[k][i]) for k in data for i in range(60)], "k string, frame_idx int, valid boolean, support boolean")
    want = set()
    for k in data:
        for a, b in brute_runs(valid[k]):
            parts = [(a + s, a + e) for s, e in brute_runs([data[k][i] > 0 for i in range(a, b)])]
            merged = []
            for s, e in parts:
                if merged and s - merged[-1][1] <= 2:
                    merged[-1] = (merged[-1][0], e, merged[-1][2] + e - s)
                else:
                    merged.append((s, e, e - s))
            want |= {(k, s, e, e - s - n) for s, e, n in merged}
    assert {(x.k, x.fs, x.fe, x.bridge_frames) for x in intervals.closing(g, ["k"], "valid", "support", 2).collect()} == want


@pytest.mark.parametrize("gap", [0.0, 1.5])
def test_merge(spark, gap):
    r = rnd(2)
    rows = [(f"k{r.randrange(4)}", s, s + r.randrange(1, 5) / 2) for s in [r.randrange(0, 80) / 2 for _ in range(120)]]
    want = set()
    for k in {x[0] for x in rows}:
        cur = None
        for _, s, e in sorted(x for x in rows if x[0] == k):
            if cur and s - cur[1] <= gap:
                cur = (cur[0], max(cur[1], e))
            else:
                if cur:
                    want.add((k, *cur))
                cur = (s, e)
        want.add((k, *cur))
    got = intervals.merge(spark.createDataFrame(rows, "k string, s double, e double"), ["k"], "s", "e", gap)
    assert {(x.k, x.s, x.e) for x in got.collect()} == want


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_overlap_join(spark, how):
    r = rnd(3)
    a = [(i, f"k{r.randrange(3)}", s, s + r.random() * 30) for i in range(80) for s in [r.random() * 200]]
    b = [(i, f"k{r.randrange(3)}", s, s + r.random() * 30) for i in range(40) for s in [r.random() * 200]]
    A = spark.createDataFrame(a, "ia int, k string, a0 double, a1 double")
    B = spark.createDataFrame(b, "ib int, k string, b0 double, b1 double")
    pairs = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]]
    got = intervals.overlap_join(A, B, ["k"], 16.0, how).collect()
    if how == "inner":
        assert sorted((x.ia, x.ib) for x in got) == sorted(pairs)
    else:
        hit = {p[0] for p in pairs}
        assert sorted(x.ia for x in got) == sorted(i for i in range(80) if (i in hit) == (how == "left_semi"))


def brute_prominence(z, ok, seed, ret, width, gap, least):
    events = []
    for side in "+-":
        s = [v if side == "+" else -v for v in z]
        for a, b in brute_runs([o and v >= seed for v, o in zip(s, ok)]):
            if b - a < width:
                continue
            peak = max(range(a, b), key=lambda i: (s[i], -i))
            lo, hi = peak, peak + 1
            while lo > 0 and ok[lo - 1] and s[lo - 1] >= ret:
                lo -= 1
            while hi < len(z) and ok[hi] and s[hi] >= ret:
                hi += 1
            events.append([lo, hi, side, a, peak, s[peak]])
    events.sort(key=lambda e: (e[0], e[1], e[2], e[3]))
    merged = []
    for e in events:
        if merged and merged[-1][2] == e[2] and e[0] - merged[-1][1] <= gap:
            m = merged[-1]
            m[1] = max(m[1], e[1])
            if e[5] > m[5]:
                m[4], m[5] = e[4], e[5]
        else:
            merged.append(list(e))
    return {(e[0], e[1], e[2], e[4], e[5]) for e in merged if e[1] - e[0] >= least}


def test_prominence(spark):
    r = rnd(4)
    data = {f"k{j}": [round(r.gauss(0, 1.5), 1) for _ in range(150)] for j in range(12)}
    ok = {k: [r.random() < 0.95 for _ in v] for k, v in data.items()}
    f = spark.createDataFrame([(k, i, data[k][i], ok[k][i]) for k in data for i in range(150)], "k string, frame_idx int, z double, valid boolean")
    got = detect.prominence(f, ["k"], 1.5, 0.5, 1, 2, 2).collect()
    want = {(k, *e) for k in data for e in brute_prominence(data[k], ok[k], 1.5, 0.5, 1, 2, 2)}
    assert {(x.k, x.fs, x.fe, x.direction, x.peak_frame, x.peak_z) for x in got} == want


def test_hysteresis_support_is_asked_after_merging(spark):
    p = [0, 0.8, 0, 0.9, 0, 0, 0, 0, 0.75, 0, 0]
    f = spark.createDataFrame([("r", i, float(x)) for i, x in enumerate(p)], "k string, frame_idx int, p double")
    got = detect.hysteresis_regions(f, ["k"], 0.7, 0.5, 0.25, 0.25, 2).collect()
    assert [(x.fs, x.fe) for x in got] == [(1, 4)]


def test_neighbour_baseline(spark):
    r = rnd(5)
    values = [round(r.gauss(0, 1), 1) for _ in range(80)]
    blocks = [(0, 0.0, 9.0), (1, 12.0, 20.0), (2, 24.0, 60.0), (3, 62.0, 64.0), (4, 70.0, 80.0)]
    block = [next((b for b, s, e in blocks if s <= i and i + 1 <= e), -1) for i in range(80)]
    f = spark.createDataFrame([("r", "t", i, values[i], block[i]) for i in range(80)], "recording_id string, track_id string, frame_idx int, value double, block_id int")
    b = spark.createDataFrame([("r", "t", *x) for x in blocks], "recording_id string, track_id string, block_id int, start_sec double, end_sec double")
    got = {(x.block_id, x.frame_idx): (x.n, x.baseline, x.scale) for x in robust.neighbour_baseline(f, b, ["recording_id", "track_id"], 1.0, 1.0, 15.0, 5.0, 0.5).collect()}
    inside = [v for v, k in zip(values, block) if k >= 0]
    m = statistics.median(inside)
    whole = max(1.4826 * statistics.median([abs(v - m) for v in inside]), 1e-9)
    want = {}
    for k, s, e in blocks:
        anchors = [(None, (s + e) / 2)] if e - s <= 15 else [(i, i + 0.5) for i in range(80) if block[i] == k]
        for i, t in anchors:
            ctx = [values[j] for j in range(80) if block[j] >= 0 and block[j] != k and abs(j + 0.5 - t) <= 15]
            if len(ctx) >= 5:
                c = statistics.median(ctx)
                want[k, i] = (len(ctx), c, max(1.4826 * statistics.median([abs(v - c) for v in ctx]), whole * 0.5))
            else:
                want[k, i] = (len(ctx), m, whole)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_clique_needs_pairwise_overlap(spark):
    rows = [("r", 0, "a", 0.0, 10.0, 5.0, 0), ("r", 1, "v", 8.0, 20.0, 4.0, 1), ("r", 2, "d", 0.0, 4.0, 3.0, 2), ("r", 3, "d", 18.0, 30.0, 2.0, 3)]
    ev = spark.createDataFrame(rows, "recording_id string, event_id long, track_id string, start_sec double, end_sec double, score double, leaf int")
    got = {(x.joint_no, x.event_id) for x in fuse.clique_fuse(ev, "recording_id", 1.0).collect()}
    assert got == {(0, 0), (0, 1)}


def test_signature_and_joint(spark):
    rows = [("r", "arousal", 2.0), ("r", "valence", -1.0), ("r", "dominance", 0.2), ("r", "arousal", -2.0)]
    df = spark.createDataFrame(rows, "r string, axis string, s double")
    axes = {"arousal": "A", "valence": "V", "dominance": "D"}
    assert df.groupBy("r").agg(fuse.signature(F.col("s"), F.col("axis"), axes, 0.5).alias("x")).first().x == "A+ V- D0"


def test_label_inheritance_prefers_overlap_then_order(spark):
    old = spark.createDataFrame([("x", 1, 0, 0.0, 10.0, "tp"), ("x", 2, 1, 0.0, 10.0, "fp"), ("x", 3, 2, 4.0, 30.0, "fp"), ("y", 4, 3, 0.0, 10.0, "tp")], "label string, old_id int, old_order int, start_sec double, end_sec double, verdict string")
    new = spark.createDataFrame([("x", 7, 1.0, 9.0), ("x", 8, 25.0, 40.0), ("y", 9, 9.0, 30.0)], "label string, event_id int, start_sec double, end_sec double")
    got = {x.event_id: x.inherited_from for x in labels.inherit(old, new, ["label"]).collect()}
    assert got == {7: 1}


def test_closure_survives_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "c")], "child_id string, parent_id string")
    got = {(x.node, x.ancestor): x.depth for x in ontology.closure(e).collect()}
    assert got[("a", "c")] == 2 and got[("d", "b")] == 3 and len(got) == 13


def test_envelope_pads_the_last_bin(spark):
    rows = [("r", i, float(v)) for i, v in enumerate([3, 4, 5, 6, 7])]
    got = {x.bin: (x.lo, x.hi) for x in summarize.envelope(spark.createDataFrame(rows, "k string, i long, value double"), ["k"], 2).collect()}
    assert got == {0: (3.0, 4.0), 1: (5.0, 6.0), 2: (0.0, 7.0)}


def test_checks(spark):
    with pytest.raises(ConfigError):
        DeviationConfig(z_seed={"_default": 0.2})
    with pytest.raises(ConfigError):
        RegionConfig(seed=0.4, shoulder=0.6)
    with pytest.raises(ConfigError):
        resolve("region", nonsense=1)
    assert resolve("region", "exploratory").seed == 0.5
    assert config_hash({"a": 1, "b": 2}) == config_hash({"b": 2, "a": 1}) != config_hash({"a": 2, "b": 2})
    assert fingerprint({"a": [{"path": "x", "v": 1}]}) == fingerprint({"a": [{"path": "y", "v": 1}]})
    with pytest.raises(DataError):
        check_frames(spark.createDataFrame([("k", 0), ("k", 2)], "k string, frame_idx int"), ["k"])


def test_streaming_rule_equals_batch():
    from spanforge.streaming.hysteresis import close_regions

    r = rnd(6)
    p = [r.choice([0.0, 0.5, 0.6, 0.9]) for _ in range(200)]
    want = [(a, b) for a, b in brute_runs([x >= 0.5 for x in p]) if max(p[a:b]) >= 0.8]
    got, state = [], None
    rows = list(enumerate(p))
    for at in range(0, 200, 17):
        out, state = close_regions(rows[at : at + 17], state, 0.8, 0.5)
        got += out
    if state and state[2]:
        got.append(state[:2])
    assert got == want


def test_nan_frames_make_no_event(spark):
    from spanforge.operators import robust

    values = [0.0, 0.1, float("nan"), float("nan"), 0.2, 0.0, None, 5.0, 5.0, 5.0, 0.1, 0.0]
    f = frames(spark, {"a": values})
    z = robust.zscores(f, robust.global_stats(f, ["k"]), ["k"]).withColumn("valid", F.lit(True))
    rows = {r.frame_idx: r.z for r in z.collect()}
    assert rows[2] == rows[3] == rows[6] == 0.0 and rows[7] > 0
    got = detect.prominence(z, ["k"], 1.5, 0.5, 1, 2, 2).collect()
    assert [(r.fs, r.fe, r.direction) for r in got] == [(7, 10, "+")]


def test_three_producers_compose_in_one_schema(spark):
    from spanforge.config import EMOTIONS
    from spanforge.plans import producers

    r = rnd(3)
    f = spark.createDataFrame([("r", s, i, (6.0 if 40 <= i < 60 else 0.0) + r.random()) for s in ("arousal", "valence") for i in range(120)], "recording_id string, track_id string, frame_idx int, value double")
    vad = spark.createDataFrame([("r", 0.0, 8.0), ("r", 9.5, 16.0), ("r", 18.0, 30.0)], "recording_id string, start_sec double, end_sec double")
    a = producers.deviation_events(f, vad, 0.25, 1.0, DeviationConfig())
    logits = spark.createDataFrame([("r", i, [0.0, 4.0 if 20 <= i < 30 else -4.0], [5.0, -5.0, -5.0, -5.0, -5.0]) for i in range(60)], "recording_id string, frame_idx int, fluency array<double>, types array<double>")
    b = producers.region_event_rows(producers.region_events(logits, 0.25, 1.0, 15.0))
    label = "anger" if "anger" in EMOTIONS else EMOTIONS[0]
    probs = [("r", i, [0.93 if (x == label) == (10 <= i < 20) and x in (label, "neutral") else 0.01 for x in EMOTIONS], True) for i in range(60)]
    c, _ = producers.class_events(spark.createDataFrame(probs, "recording_id string, frame_idx int, values array<double>, valid boolean"), 0.25, 1.0)
    c = producers.class_event_rows(c, 0.25, 1.0, 15.0)
    every = producers.compose(a, b, c)
    assert every.columns == producers.EVENT_COLUMNS
    rows = every.collect()
    assert "disfluency.default.instance.000000" in {x.event_id for x in rows} and len({x.event_id for x in rows}) == len(rows)
    assert all(x.end_sec >= x.start_sec and abs(x.duration_sec - (x.end_sec - x.start_sec)) < 1e-9 for x in rows)
    runs = {x.producer_id: (x.n_events, x.config_hash) for x in producers.producer_runs(every, {"disfluency.default": "h"}).collect()}
    assert runs["disfluency.default"] == (1, "h")


def test_valid_frame_policy(spark):
    from spanforge.plans import producers

    f = spark.createDataFrame([("a", 0, True), ("a", 1, False), ("b", 0, False)], "recording_id string, frame_idx int, speech boolean")
    got = {(r.recording_id, r.frame_idx): (r.valid, r.frame_policy, r.warning) for r in producers.valid_frames(f, f, ["recording_id"]).collect()}
    assert got == {("a", 0): (True, "speech_frames", None), ("a", 1): (False, "speech_frames", None), ("b", 0): (False, "none_no_speech", "vad_found_no_speech")}
    assert {(r.valid, r.frame_policy) for r in producers.valid_frames(f, None, ["recording_id"]).collect()} == {(False, "none_missing_vad")}
    assert {(r.valid, r.frame_policy) for r in producers.valid_frames(f, None, ["recording_id"], require_vad=False).collect()} == {(True, "all_frames_debug")}


def test_histogram_counts_every_value(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (-50, 0, 1, 2, 560)] + [("b", 3.0), ("c", None)], "k string, value double")
    got = {(r.k, r.bin): r.n for r in summarize.histogram(rows, ["k"], 4).collect()}
    assert got == {("a", 0): 4, ("a", 3): 1, ("b", 0): 1}


def test_closure_of_diamonds_and_cycles(spark):
    edges = [(f"n{i}{s}", f"n{i + 1}{t}") for i in range(12) for s in "ab" for t in "ab"] + [("x", "y"), ("y", "x")]
    got = {(r.node, r.ancestor): r.depth for r in ontology.closure(spark.createDataFrame(edges, "child_id string, parent_id string")).collect()}
    assert got[("n0a", "n12b")] == 12 and got[("x", "x")] == 0 and got[("x", "y")] == 1
    assert len(got) == sum(1 + 2 * (12 - i) for i in range(13) for _ in "ab") + 4


def test_mel_scale_is_linear_then_logarithmic():
    import numpy as np

    from spanforge.functions import signal

    assert np.allclose(signal.hz_to_mel(np.array([0.0, 500.0, 1000.0, 6400.0])), [0, 7.5, 15, 42])
    assert np.allclose(signal.mel_to_hz(signal.hz_to_mel(np.array([60.0, 999.0, 4000.0]))), [60, 999, 4000])
    bank = signal.mel_filters(16000, 512, 64, 50.0, 8000.0)
    assert bank.shape == (64, 257) and (bank >= 0).all()
