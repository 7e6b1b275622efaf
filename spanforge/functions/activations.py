"""Row-wise activations and class-vector scalars over ARRAY<DOUBLE> columns, all on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(a: Column) -> Column:
    """Stable softmax: the largest element is subtracted first."""
    e = F.transform(a, lambda x: F.exp(x - F.array_max(a)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def sigmoid(x: Column) -> Column:
    """Two branches, so that exp never overflows."""
    return F.when(x >= 0, 1.0 / (1.0 + F.exp(-x))).otherwise(F.exp(x) / (1.0 + F.exp(x)))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def row_normalise(a: Column) -> Column:
    """Non-negative scores to shares; a zero row is an error."""
    return F.when(total(a) > 0, F.transform(a, lambda x: x / total(a))).otherwise(F.raise_error(F.lit("scores of a frame sum to zero")))


def adapt_scores(a: Column, all_near_one: Column, all_non_negative: Column) -> Column:
    """Probabilities pass, non-negative scores are normalised, anything else goes through softmax; the two facts hold for the
    whole track."""
    return F.when(all_near_one, a).when(all_non_negative, row_normalise(a)).otherwise(softmax(a))


def argmax(a: Column) -> Column:
    """0-based index of the first largest element."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def top2_margin(a: Column) -> Column:
    s = F.sort_array(a, asc=False)
    return F.element_at(s, 1) - F.element_at(s, 2)


def pick(a: Column, channels: list[int]) -> Column:
    return F.array(*[F.get(a, i) for i in channels])


def background_margin(a: Column, channels: list[int]) -> tuple[Column, Column]:
    """(best background probability, its channel)."""
    part = pick(a, channels)
    best = F.array_max(part)
    return best, F.element_at(F.array(*[F.lit(c) for c in channels]), F.array_position(part, best).cast("int"))


def mass(a: Column, channels: list[int]) -> Column:
    return total(pick(a, channels))


def share(a: Column, channels: list[int]) -> Column:
    """Each channel's part of the channels' mass, with a floor of 1e-9."""
    m = F.greatest(mass(a, channels), F.lit(1e-9))
    return F.transform(pick(a, channels), lambda x: x / m)


def entropy(a: Column) -> Column:
    """Natural-log Shannon entropy; probabilities are clipped to [1e-12, 1] in the logarithm."""
    return -F.aggregate(a, F.lit(0.0), lambda s, p: s + p * F.ln(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-12))))


def topk(a: Column, names: list[str], k: int) -> Column:
    """The k largest as structs (p, name); ties go to the lower channel."""
    rows = F.transform(a, lambda p, i: F.struct((-p).alias("n"), i.alias("i"), p.alias("p"), F.get(F.array(*map(F.lit, names)), i).alias("name")))
    return F.transform(F.slice(F.array_sort(rows), 1, k), lambda s: F.struct(s["p"].alias("p"), s["name"].alias("name")))


def clip01(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0))


def normalize_label(x: Column, aliases: dict[str, str]) -> Column:
    """Trimmed text after the last slash, lower case, then the alias map; an unknown label passes."""
    base = F.lower(F.trim(F.element_at(F.split(F.trim(x), "/"), -1)))
    table = F.create_map(*[F.lit(v) for kv in aliases.items() for v in kv])
    return F.coalesce(table[base], base)


def clock(seconds: Column) -> Column:
    """mm:ss:mmm."""
    ms = F.round(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%03d", F.floor(ms / 60000), F.floor(ms / 1000) % 60, ms % 1000)


def safe_filename(x: Column) -> Column:
    """Letters, digits and -_. stay, the rest becomes _; empty becomes 'recording'."""
    s = F.regexp_replace(x, r"[^\p{L}\p{N}\-_.]", "_")
    return F.when(s == "", "recording").otherwise(s)


def event_id(producer: str, kind: str, n: Column) -> Column:
    return F.concat(F.lit(f"{producer}.{kind}."), F.format_string("%06d", n))


def enframe(samples: Column, win: int, hop: int, pad_tail: bool = True) -> Column:
    """Array of windows. With ``pad_tail`` the last partial window survives, filled with zeros; else it is dropped."""
    n = F.size(samples)
    if pad_tail:
        count = F.when(n <= win, 1).otherwise(1 + F.ceil((n - win) / hop)).cast("int")
        padded = F.concat(samples, F.array_repeat(F.lit(0.0).cast("double"), F.greatest(F.lit(0), (count - 1) * hop + win - n)))
    else:
        count, padded = F.when(n < win, 0).otherwise(1 + F.floor((n - win) / hop)).cast("int"), samples
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(padded, i * hop + 1, F.lit(win)))).otherwise(F.array().cast("array<array<double>>"))


def fade(samples: Column, n: int) -> Column:
    """Linear fade in and out over n samples."""
    size = F.size(samples)
    return F.transform(samples, lambda x, i: x * F.least(F.lit(1.0), (i + 1) / F.lit(float(n)), (size - i) / F.lit(float(n))))


def fit_length(samples: Column, n: int, loop: bool = False) -> Column:
    """Trim, and loop or zero-pad, to n samples."""
    size = F.size(samples)
    longer = F.flatten(F.array_repeat(samples, F.ceil(F.lit(n) / F.greatest(size, F.lit(1))).cast("int"))) if loop else F.concat(samples, F.array_repeat(F.lit(0.0).cast("double"), F.greatest(F.lit(0), F.lit(n) - size)))
    return F.slice(longer, 1, n)


def peak_normalise(samples: Column, level: float) -> Column:
    peak = F.array_max(F.transform(samples, lambda x: F.abs(x)))
    return F.when(peak > 0, F.transform(samples, lambda x: x / peak * level)).otherwise(samples)
