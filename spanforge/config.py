"""Producer configurations: frozen, checked on construction, with presets and strict overrides."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields, replace

#: Class order of the emotion producer (it decides ties), its events and its background classes.
EMOTIONS = ("anger", "disgust", "fear", "happiness", "neutral", "other", "sadness", "surprise")
BACKGROUND = ("neutral", "other")
EVENT_EMOTIONS = ("anger", "disgust", "fear", "happiness", "sadness", "surprise")
#: Disfluency types in model order (it decides ties).
DISFLUENCIES = ("Block", "Prolongation", "Sound Repetition", "Word Repetition", "Interjection")
#: What a score may be called, and the verdicts of a review.
SCORE_NAMES = ("peak_z", "peak_probability", "joint_strength", "mean_probability", "support", "probability")
VERDICTS = ("tp", "fp", "unclear", "partial")


class ConfigError(ValueError):
    """A configuration value is out of range or unknown."""


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


@dataclass(frozen=True)
class DeviationConfig:
    vad_merge_gap_sec: float = 0.5
    min_speech_block_sec: float = 0.75
    radius_sec: float = 120.0
    min_context_sec: float = 5.0
    scale_floor_frac: float = 0.5
    z_seed: dict = field(default_factory=lambda: {"valence": 1.5, "_default": 1.8})
    seed_min_width_sec: float = 1.0
    z_return: float = 0.5
    min_duration_sec: float = 2.0
    merge_gap_sec: float = 0.5
    cross_signal_min_overlap_sec: float = 1.0
    signature_z_threshold: float = 0.5

    def __post_init__(self):
        for f in fields(self):
            if f.name != "z_seed":
                _need(getattr(self, f.name) >= 0, f"{f.name} must not be negative")
        low = min(self.z_seed.values()) if isinstance(self.z_seed, dict) else self.z_seed
        _need(self.z_return <= low, "z_return must not exceed z_seed")

    def seed_for(self, signal: str) -> float:
        return parameter(self.z_seed, signal)


@dataclass(frozen=True)
class RegionConfig:
    seed: float = 0.70
    shoulder: float = 0.50
    min_support_sec: float = 0.50
    merge_gap_sec: float = 0.50
    type_threshold: float = 0.70
    suppressed_types: tuple = ("Sound Repetition",)
    emit_unspecified: bool = False

    def __post_init__(self):
        for name in ("seed", "shoulder", "type_threshold"):
            _need(0 <= getattr(self, name) <= 1, f"{name} must lie in [0, 1]")
        _need(self.shoulder <= self.seed, "shoulder must not exceed seed")
        _need(self.min_support_sec >= 0 and self.merge_gap_sec >= 0, "durations must not be negative")
        _need(set(self.suppressed_types) <= set(DISFLUENCIES), "unknown suppressed type")


@dataclass(frozen=True)
class ClassConfig:
    absolute_min_probability: float = 0.60
    class_quantile: float = 0.90
    background_margin: float = 0.15
    min_duration_sec: float = 1.0
    support_close_gap_sec: float = 1.0
    probability_sum_tolerance: float = 1e-3
    event_labels: tuple = EVENT_EMOTIONS
    background_labels: tuple = BACKGROUND
    require_vad_for_events: bool = True

    def __post_init__(self):
        for name in ("absolute_min_probability", "class_quantile", "background_margin"):
            _need(0 <= getattr(self, name) <= 1, f"{name} must lie in [0, 1]")
        _need(self.min_duration_sec > 0 and self.support_close_gap_sec >= 0, "durations out of range")
        _need(set(self.event_labels) | set(self.background_labels) <= set(EMOTIONS), "unknown label")
        _need(not set(self.event_labels) & set(self.background_labels), "event and background labels overlap")


PRESETS = {
    ("deviation", "exploratory"): {"z_seed": {"_default": 1.5}}, ("deviation", "conservative"): {"z_seed": {"_default": 2.25}},
    ("region", "exploratory"): {"seed": 0.50, "shoulder": 0.40}, ("region", "conservative"): {"seed": 0.85, "shoulder": 0.65},
    ("class", "exploratory"): {"absolute_min_probability": 0.50, "class_quantile": 0.85, "background_margin": 0.10, "min_duration_sec": 0.75},
    ("class", "conservative"): {"absolute_min_probability": 0.70, "class_quantile": 0.95, "background_margin": 0.25, "min_duration_sec": 1.5},
}
_KINDS = {"deviation": DeviationConfig, "region": RegionConfig, "class": ClassConfig}


def resolve(kind: str, preset: str | None = None, **overrides):
    """A configuration by kind and preset; an unknown field is an error."""
    _need(kind in _KINDS, f"unknown producer {kind}")
    base = _KINDS[kind]()
    if preset not in (None, "default"):
        _need((kind, preset) in PRESETS, f"unknown preset {preset}")
        base = replace(base, **PRESETS[kind, preset])
    unknown = set(overrides) - {f.name for f in fields(base)}
    _need(not unknown, f"unknown fields {sorted(unknown)}")
    return replace(base, **overrides)


def parameter(value, signal: str) -> float:
    """A scalar, or a map by signal with ``_default``."""
    if isinstance(value, dict):
        _need(signal in value or "_default" in value, f"no value for {signal}")
        return float(value.get(signal, value.get("_default")))
    return float(value)


def canonical_json(value) -> str:
    """Sorted, compact, UTF-8 kept; NaN is refused."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False, default=str)


def config_hash(config) -> str:
    """First 16 hex digits of the sha256 of the sorted JSON."""
    value = asdict(config) if hasattr(config, "__dataclass_fields__") else config
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


#: Keys that say where something is kept; they do not enter a fingerprint.
VOLATILE = frozenset({"package_fingerprint", "package_id", "manifest_path", "path", "audio_path", "data_path"})
#: Fixed value: the schema a package names.
PACKAGE_SCHEMA = "review_package.v1"


def fingerprint(value) -> str:
    """sha256 of the canonical JSON without volatile keys, at any depth."""

    def strip(v):
        if isinstance(v, dict):
            return {k: strip(x) for k, x in v.items() if k not in VOLATILE}
        if isinstance(v, list | tuple):
            return [strip(x) for x in v]
        return v

    return hashlib.sha256(canonical_json(strip(value)).encode()).hexdigest()
