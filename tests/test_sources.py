"""Audio, artifacts, packages, the model slot, producers end to end, the stream, and spectral kernels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.config import DeviationConfig
from spanforge.functions import activations as act
from spanforge.functions import signal
from spanforge.operators import robust
from spanforge.plans import inference, producers
from spanforge.sources import audio, store
from spanforge.streaming import hysteresis


def test_audio_round_trip(spark, tmp_path):
    (tmp_path / "speech").mkdir()
    x = 0.5 * np.sin(np.arange(8000) / 20)
    audio.write_wav(str(tmp_path / "speech" / "a b.wav"), x, 8000)
    (tmp_path / "speech" / "broken.wav").write_bytes(b"no audio")
    got = {r.recording_id: r for r in audio.load(spark, str(tmp_path), 8000).collect()}
    assert got["a_b"].category == "speech" and got["a_b"].duration_sec == pytest.approx(1.0)
    assert np.allclose(got["a_b"].samples, x, atol=1e-3) and got["a_b"].audio_sha256 == audio.sample_hash(np.array(got["a_b"].samples, "<f4"))
    assert got["broken"].samples is None and got["broken"].error
    assert audio.discover(spark, str(tmp_path)).count() == 2


def test_artifacts_are_reused(spark, tmp_path):
    rec = spark.createDataFrame([("r1", "f" * 64, [float(i) for i in range(40)])], "recording_id string, audio_sha256 string, samples array<double>")
    tasks = {"affect": (lambda w: w.mean(axis=1, keepdims=True), {"window_sec": 1.0, "hop_sec": 0.5, "batch": 3})}
    root = str(tmp_path / "store")
    assert inference.run_all(spark, rec, root, tasks, 10) == {"affect": False}
    assert inference.run_all(spark, rec, root, tasks, 10) == {"affect": True}
    done = store.list_artifacts(spark, root, task="affect").collect()
    assert len(done) == 1 and done[0].n_frames == 7
    key = done[0].asDict()
    key.pop("n_frames")
    first = store.find_artifact(spark, root, key).orderBy("frame_idx").first()
    assert first["values"][0] == pytest.approx(np.mean(range(10)))
    assert store.find_artifact(spark, root, key | {"config_hash": "0"}) is None
    assert [r.recording_id for r in inference.one_audio(store.manifests(spark, root), ("affect",)).collect()] == ["r1"]


def test_package_is_idempotent(spark, tmp_path):
    ev = spark.createDataFrame([("e1", 1.0), ("e0", 2.0)], "event_id string, score double")
    a = store.write_package(spark, str(tmp_path), {"recording_id": "r", "audio_path": "x"}, ev)
    assert a == store.write_package(spark, str(tmp_path), {"recording_id": "r", "audio_path": "y"}, ev)
    assert a != store.write_package(spark, str(tmp_path), {"recording_id": "q"}, ev)
    body, events = store.load_package(spark, str(tmp_path), a)
    assert body["package_id"] == a and events.count() == 2


def test_enframe_keeps_or_drops_the_tail(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],)], "s array<double>")
    assert df.select(act.enframe(F.col("s"), 4, 2).alias("x")).first().x == [[1, 2, 3, 4], [3, 4, 5, 0]]
    assert df.select(act.enframe(F.col("s"), 4, 2, False).alias("x")).first().x == [[1, 2, 3, 4]]


def test_deviation_producer_finds_the_shift(spark):
    rng = np.random.default_rng(7)
    n, hop, window = 420, 0.25, 3.5
    vad = [(0.0, 20.0), (24.0, 44.0), (50.0, 70.0), (76.0, 100.0)]
    rows = []
    for t in ("arousal", "valence"):
        v = rng.normal(0, 0.04, n)
        for i in range(n):
            if i * hop >= 52 and i * hop + window <= 68:
                v[i] += 0.55
            rows.append(("r", t, i, float(v[i])))
    f = spark.createDataFrame(rows, "recording_id string, track_id string, frame_idx int, value double")
    got = producers.deviation_events(f, spark.createDataFrame([("r", *x) for x in vad], "recording_id string, start_sec double, end_sec double"), hop, window, DeviationConfig(), ["arousal", "valence"]).collect()
    big = [x for x in got if x.event_type == "deviation" and x.score > 5]
    assert {x.label for x in big} == {"arousal_deviation", "valence_deviation"} and all(50 <= x.start_sec and x.end_sec <= 70 for x in big)
    joint = [x for x in got if x.event_type == "joint"]
    assert joint and all(x.parent_id for x in big) and len({x.event_id for x in got}) == len(got)


def test_stream_equals_batch(spark, tmp_path):
    p = [0.0, 0.6, 0.9, 0.6, 0.0, 0.6, 0.0, 0.95, 0.0]
    src = str(tmp_path / "in")
    spark.createDataFrame([("k", i, x) for i, x in enumerate(p)], "recording_id string, frame_idx long, p double").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("recording_id string, frame_idx long, p double").parquet(src)
    q = hysteresis.regions(stream, "recording_id", 0.8, 0.5).writeStream.format("memory").queryName("regions_out").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.fs, r.fe) for r in spark.table("regions_out").collect()) == [(1, 4), (7, 8)]


def test_spectrum_peaks_at_the_tone(spark):
    x = np.sin(2 * np.pi * 1000 * np.arange(4000) / 8000)
    assert int(signal.power_frames(x, 512, 160)[5].argmax()) == 64
    df = spark.createDataFrame([(x.tolist(),), (None,)], "s array<double>")
    got = df.select(signal.log_mel(F.col("s"), 8000).alias("m")).collect()
    assert len(got[0].m) == 1 + 4000 // 160 and len(got[0].m[0]) == 64 and got[1].m is None


def test_rolling_statistics_match_numpy(spark):
    rng = np.random.default_rng(3)
    v = [None if rng.random() < 0.2 else float(round(x, 1)) for x in rng.normal(0, 1, 60)]
    df = spark.createDataFrame([("k", i, x) for i, x in enumerate(v)], "k string, frame_idx int, value double")
    got = [r.moving_median for r in robust.moving_median(df, ["k"], 3).orderBy("frame_idx").collect()]
    for i in range(60):
        part = [x for x in v[max(0, i - 3) : i + 4] if x is not None]
        assert got[i] is None if not part else got[i] == pytest.approx(np.median(part))


def test_small_tables(spark, tmp_path):
    from spanforge.sources import tables

    (tmp_path / "c.csv").write_text('index,mid,display_name\n0,/m/1,"Speech, male"\n')
    (tmp_path / "m.json").write_text('{"Speech": "voice"}')
    (tmp_path / "r1.json").write_text('{"duration": 5.0, "segments": [{"start": 0, "end": 2.5, "type": "speech"}], "sfx_events": [{"start": 1, "end": 2, "type": "sfx"}]}')
    assert tables.classes(spark, str(tmp_path / "c.csv")).first().display_name == "Speech, male"
    assert tables.category_map(spark, str(tmp_path / "m.json")).first().category == "voice"
    got = tables.timelines(spark, str(tmp_path / "r1.json"))
    assert sorted((r.recording_id, r.kind, r.start_sec, r.end_sec) for r in got.collect()) == [("r1", "segment", 0.0, 2.5), ("r1", "sfx", 1.0, 2.0)]
    tables.write_timeline(got, str(tmp_path / "out"), 5.0)
    assert spark.read.json(str(tmp_path / "out")).first().segments[0].end == 2.5
    assert tables.sessions(spark, str(tmp_path / "m.json")).first().body.startswith("{")


def test_a_package_of_another_schema_or_content_is_refused(spark, tmp_path):
    from spanforge.config import fingerprint

    assert fingerprint({"a": 1, "data_path": "x"}) == fingerprint({"a": 1, "data_path": "y"}) != fingerprint({"a": 2})
    assert fingerprint({"a": 1, "predictions_path": "x"}) != fingerprint({"a": 1, "predictions_path": "y"})
    ev = spark.createDataFrame([("e1", 1.0), ("e2", 2.0)], "event_id string, score double")
    root = str(tmp_path)
    other = store.write_package(spark, root, {"recording_id": "r", "schema": "other"}, ev)
    with pytest.raises(ValueError, match="schema"):
        store.load_package(spark, root, other)
    good = store.write_package(spark, root, {"recording_id": "r"}, ev)
    assert store.load_package(spark, root, good)[1].count() == 2
    ev.filter("score > 1").write.mode("overwrite").parquet(f"{root}/{good}/events")
    with pytest.raises(ValueError, match="match"):
        store.load_package(spark, root, good)
