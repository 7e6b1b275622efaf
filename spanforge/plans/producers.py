"""The three producers and their composition: frames and intervals in, events in one schema out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import timing
from ..config import BACKGROUND, DISFLUENCIES, EMOTIONS, ClassConfig, DeviationConfig, RegionConfig
from ..functions import activations as act
from ..operators import detect, fuse, robust, summarize
from ..operators import intervals as iv
from ..schema import null_nan

EVENT_COLUMNS = ["recording_id", "event_id", "producer_id", "task", "event_type", "label", "start_sec", "end_sec", "duration_sec", "source_track_ids", "score", "score_name", "direction", "parent_id", "children"]


def speech_blocks(vad: DataFrame, config: DeviationConfig) -> DataFrame:
    return iv.merge(vad, ["recording_id"], "start_sec", "end_sec", config.vad_merge_gap_sec, config.min_speech_block_sec)


def deviation_scores(frames: DataFrame, vad: DataFrame, hop: float, window: float, config: DeviationConfig) -> DataFrame:
    """frames with block_id, center, scale, valid and z."""
    blocks = speech_blocks(vad, config)
    keys = ["recording_id", "track_id"]
    placed = iv.assign_blocks(frames, blocks, ["recording_id"], hop, window)
    per_track = frames.select("track_id", "recording_id").distinct().join(blocks, "recording_id")
    anchors = robust.neighbour_baseline(placed, per_track, keys, hop, window, config.radius_sec, config.min_context_sec, config.scale_floor_frac)
    scored = robust.with_baseline(placed, anchors, keys)
    ok = (F.col("block_id") >= 0) & null_nan(F.col("value")).isNotNull() & F.col("center").isNotNull() & F.col("scale").isNotNull()
    return scored.withColumn("valid", ok).withColumn("z", F.when(ok, (F.col("value") - F.col("center")) / F.col("scale")).otherwise(0.0))


def deviation_events(frames: DataFrame, vad: DataFrame, hop: float, window: float, config: DeviationConfig | None = None, signals: list[str] | None = None) -> DataFrame:
    """Leaf and joint events of several signals (tracks) per recording."""
    config = config or DeviationConfig()
    scored = deviation_scores(frames, vad, hop, window, config)
    signals = signals or sorted(r[0] for r in frames.select("track_id").distinct().collect())
    seed = F.coalesce(*[F.when(F.col("track_id") == s, F.lit(config.seed_for(s))) for s in signals])
    scored = scored.withColumn("_seed", seed)
    got = detect.prominence(scored.withColumn("track_seed", seed), ["recording_id", "track_id", "_seed"], F.col("_seed"), config.z_return, timing.seed_frames(config.seed_min_width_sec, hop), timing.merge_gap_frames(config.merge_gap_sec, hop), timing.min_event_frames(config.min_duration_sec, hop)).drop("_seed")
    got = got.withColumn("pos", F.array_position(F.array(*map(F.lit, signals)), F.col("track_id")))
    got = fuse.number_events(got, ["recording_id"], ["pos", "fs", "fe", "direction"])
    leaves = got.select(
        "recording_id", act.event_id("affect.default", "deviation", F.col("n")).alias("event_id"), "track_id", (F.col("fs") * hop + window / 2).alias("start_sec"), ((F.col("fe") - 1) * hop + window / 2).alias("end_sec"),
        F.col("peak_z").alias("score"), "direction", "peak_frame", F.col("n").alias("leaf"),
    )
    members = fuse.clique_fuse(leaves, "recording_id", config.cross_signal_min_overlap_sec)
    joint = fuse.joints(leaves, members, "recording_id")
    count = leaves.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n_leaves"))
    joint = joint.join(count, "recording_id").withColumn("joint_id", act.event_id("affect.default", "joint", F.col("n_leaves") + F.col("joint_no")))
    leaves = fuse.attach_parents(leaves, joint, "recording_id")
    common = [F.lit("affect.default").alias("producer_id"), F.lit("affect").alias("task")]
    dur = (F.col("end_sec") - F.col("start_sec")).alias("duration_sec")
    a = leaves.select("recording_id", "event_id", *common, F.lit("deviation").alias("event_type"), F.concat("track_id", F.lit("_deviation")).alias("label"), "start_sec", "end_sec", dur, F.array("track_id").alias("source_track_ids"), "score", F.lit("peak_z").alias("score_name"), "direction", "parent_id", F.array().cast("array<string>").alias("children"))
    b = joint.select("recording_id", F.col("joint_id").alias("event_id"), *common, F.lit("joint").alias("event_type"), F.lit("joint").alias("label"), "start_sec", "end_sec", dur, F.col("tracks").alias("source_track_ids"), "score", F.lit("joint_strength").alias("score_name"), F.lit(None).cast("string").alias("direction"), F.lit(None).cast("string").alias("parent_id"), "children")
    return a.unionByName(b)


def region_events(logits: DataFrame, hop: float, window: float, duration: float | None = None, config: RegionConfig | None = None) -> DataFrame:
    """Disfluency events. logits: recording_id, frame_idx, fluency ARRAY<2>, types ARRAY<5>."""
    config = config or RegionConfig()
    keys = ["recording_id"]
    f = logits.select(*keys, "frame_idx", F.get(act.softmax(F.col("fluency")), 1).alias("p"), F.transform("types", act.sigmoid).alias("tp"))
    regions = detect.hysteresis_regions(f, keys, config.seed, config.shoulder, config.merge_gap_sec, hop, timing.support_frames(config.min_support_sec, hop))
    rows = detect.in_ranges(f, regions, keys)
    at = detect.first_max(F.col("tp"), F.col("p"), F.col("frame_idx"))
    n = len(DISFLUENCIES)
    got = rows.groupBy(*keys, "fs", "fe").agg(F.max("p").alias("peak_p"), F.avg("p").alias("mean_p"), detect.first_max(F.col("frame_idx"), F.col("p"), F.col("frame_idx")).alias("peak_frame"), at.alias("at_peak"), *[F.max(F.get("tp", i)).alias(f"max{i}") for i in range(n)])
    options = lambda suppressed: F.array_compact(F.array(*[F.when(F.col(f"max{i}") >= config.type_threshold, F.struct(F.get("at_peak", i).alias("p"), F.lit(-i).alias("o"), F.lit(t).alias("name"))) for i, t in enumerate(DISFLUENCIES) if (t in config.suppressed_types) == suppressed]))
    got = got.withColumn("useful", options(False)).withColumn("muted", options(True))
    best, mute = F.array_max("useful"), F.array_max("muted")
    veto = (F.size("muted") > 0) & (F.size("useful") > 0) & (mute["p"] >= best["p"])
    got = got.withColumn("label", F.when(veto, None).when(F.size("useful") > 0, F.replace(F.lower(best["name"]), F.lit(" "), F.lit("_"))).when(F.size("muted") > 0, None).when(F.lit(config.emit_unspecified), "disfluent"))
    got = got.withColumn("outcome", F.when(veto, "vetoed").when(F.size("useful") > 0, "typed").when(F.size("muted") > 0, "suppressed").otherwise("unspecified"))
    mid = lambda i: F.col(i) * hop + window / 2
    end = mid("fe") - hop + hop / 2
    return got.select(*keys, "fs", "fe", "label", "outcome", "peak_p", "mean_p", "peak_frame", F.greatest(F.lit(0.0), mid("fs") - hop / 2).alias("start_sec"), (end if duration is None else F.least(end, F.lit(float(duration)))).alias("end_sec"))


def class_events(frames: DataFrame, hop: float, window: float, config: ClassConfig | None = None, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, thresholds) of the class producer. frames: keys, frame_idx, values (the 8 classes), valid."""
    config, keys = config or ClassConfig(), keys or ["recording_id"]
    long_ = frames.select(*keys, "valid", F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.get("values", EMOTIONS.index(x)).alias("p")) for x in config.event_labels])).alias("c")).select(*keys, "valid", "c.label", "c.p")
    limit = summarize.thresholds(long_, keys, config.absolute_min_probability, config.class_quantile)
    support = detect.class_support(frames, keys, limit, config.event_labels, EMOTIONS, config.background_labels or BACKGROUND, config.background_margin)
    return detect.class_candidates(support, keys, timing.closing_gap_frames(config.support_close_gap_sec, hop), timing.class_min_frames(config.min_duration_sec, hop)), limit


def suppressed_frames(frames: DataFrame, keys: list[str], limit: DataFrame, config: ClassConfig | None = None) -> DataFrame:
    """Per label the count and top probability of frames that pass the class test outside speech; labels without any have zero rows."""
    config = config or ClassConfig()
    support = detect.class_support(frames.withColumn("_ok", ~F.col("valid")), keys, limit, config.event_labels, EMOTIONS, config.background_labels, config.background_margin, valid="_ok")
    return support.groupBy(*keys, "label").agg(F.count_if("support").alias("n"), F.max(F.when(F.col("support"), F.col("p"))).alias("max_p"))


#: The names that events of the region and the class producer carry.
REGION_ID, REGION_TASK, REGION_TYPE, REGION_TRACKS = "disfluency.default", "disfluency", "instance", ("disfluency.fluency", "disfluency.type")
CLASS_ID, CLASS_TASK, CLASS_TYPE, CLASS_TRACKS = "emotion.categorical.v1", "emotion", "categorical", ("emotion.categorical.probabilities",)


def _projected(rows: DataFrame, order: list[str], producer: str, task: str, kind: str, tracks: tuple[str, ...], score: str) -> DataFrame:
    rows = fuse.number_events(rows, ["recording_id"], [F.col(c) for c in order])
    none = F.lit(None).cast("string")
    return rows.select(
        "recording_id", act.event_id(producer, kind, F.col("n")).alias("event_id"), F.lit(producer).alias("producer_id"), F.lit(task).alias("task"), F.lit(kind).alias("event_type"), "label",
        "start_sec", "end_sec", (F.col("end_sec") - F.col("start_sec")).alias("duration_sec"), F.array(*map(F.lit, tracks)).alias("source_track_ids"), F.col(score).alias("score"),
        F.lit("probability").alias("score_name"), none.alias("direction"), none.alias("parent_id"), F.array().cast("array<string>").alias("children"),
    )


def region_event_rows(regions: DataFrame) -> DataFrame:
    """Emitted regions of ``region_events`` as events, numbered in order of time."""
    return _projected(regions.filter("label is not null"), ["fs", "fe"], REGION_ID, REGION_TASK, REGION_TYPE, REGION_TRACKS, "peak_p")


def class_event_rows(candidates: DataFrame, hop: float, window: float, duration: float | None = None) -> DataFrame:
    """Candidates of ``class_events`` as events between the centres of their outer frames, half a hop wider, inside the recording;
    numbered by start and label."""
    end = (F.col("fe") - 1) * hop + window / 2 + hop / 2
    rows = candidates.withColumns({"start_sec": F.greatest(F.lit(0.0), F.col("fs") * hop + window / 2 - hop / 2), "end_sec": end if duration is None else F.least(end, F.lit(float(duration)))})
    return _projected(rows, ["start_sec", "label"], CLASS_ID, CLASS_TASK, CLASS_TYPE, CLASS_TRACKS, "peak_p")


def valid_frames(frames: DataFrame, vad: DataFrame | None, keys: list[str], speech: str = "speech", require_vad: bool = True) -> DataFrame:
    """``frames`` with ``valid`` and per recording ``frame_policy`` and ``warning``: speech frames where there is speech; none where activity is
    required and missing, or holds no speech; all frames where it is missing and not required. ``speech`` marks frames in speech."""
    if vad is None:
        policy, warning = ("none_missing_vad", "vad_required_but_missing") if require_vad else ("all_frames_debug", None)
        return frames.withColumns({"valid": F.lit(not require_vad), "frame_policy": F.lit(policy), "warning": F.lit(warning).cast("string")})
    some = frames.groupBy(*keys).agg(F.bool_or(speech).alias("_some"))
    got = frames.join(some, keys).withColumn("valid", F.col(speech))
    return got.withColumns({"frame_policy": F.when(F.col("_some"), "speech_frames").otherwise("none_no_speech"), "warning": F.when(~F.col("_some"), "vad_found_no_speech")}).drop("_some")


def producer_runs(events: DataFrame, configs: dict[str, str]) -> DataFrame:
    """One run record per recording and producer: its configuration's hash and how many events it gave. configs: producer_id -> hash."""
    names = F.create_map(*[F.lit(x) for kv in configs.items() for x in kv])
    return events.groupBy("recording_id", "producer_id", "task").agg(F.count(F.lit(1)).alias("n_events")).withColumn("config_hash", F.try_element_at(names, F.col("producer_id")))


def compose(*producers: DataFrame) -> DataFrame:
    """Union of producers' events (``deviation_events``, ``region_event_rows``, ``class_event_rows``) in the common columns."""
    out = producers[0].select(EVENT_COLUMNS)
    for p in producers[1:]:
        out = out.unionByName(p.select(EVENT_COLUMNS))
    return out
