"""Scalar rules as Column expressions; none runs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Status ranks, truth words and null words of the input files.
STATUS_RANK = {"A": 4, "B": 3, "C": 2, "K": 1}
TRUE_WORDS = ("true", "1", "yes", "y")
NULL_WORDS = ("", "nan", "none", "null", "<na>")


def to_number(c: Column) -> Column:
    """A finite double or null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def normalise_id(c: Column) -> Column:
    """Numeric ids without a fraction as text; anything else is empty."""
    return F.coalesce(to_number(c).try_cast("bigint").cast("string"), F.lit(""))


def clean_text(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def truthy(c: Column, strip: bool = True) -> Column:
    word = F.lower(c.cast("string"))
    return F.coalesce((F.trim(word) if strip else word).isin(*TRUE_WORDS), F.lit(False))


def strip_tz(c: Column) -> Column:
    """A time without its offset, which is dropped and not applied."""
    return F.regexp_replace(F.trim(c), r"(Z|[+-]\d{2}:?\d{2})$", "")


def parse_walltime(c: Column, tz: str) -> Column:
    """Local time of a text; null if it is not a time, lies in a gap of the zone or comes twice there."""
    bare = F.regexp_replace(strip_tz(c), "T", " ")
    wall = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")])
    utc = F.to_utc_timestamp(wall, tz)
    hour = F.expr("INTERVAL 1 HOUR")
    twice = (F.from_utc_timestamp(utc + hour, tz) == wall) | (F.from_utc_timestamp(utc - hour, tz) == wall)
    return F.when((F.from_utc_timestamp(utc, tz) == wall) & ~twice, wall)


def format_iso_offset(wall: Column, tz: str) -> Column:
    """A local time as ISO text with the zone's offset."""
    minutes = ((F.unix_timestamp(wall) - F.unix_timestamp(F.to_utc_timestamp(wall, tz))) / 60).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), sign, two(F.abs(minutes) / 60), F.lit(":"), two(F.abs(minutes) % 60))


def normalise_code(c: Column) -> Column:
    """Trimmed code; null words are null and a fraction of zeros goes."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*NULL_WORDS), F.regexp_replace(F.regexp_replace(t, r"\s+", ""), r"^(\d+)\.0+$", "$1"))


def classify_prefix(code: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The class of the first rule whose prefix the code has."""
    out = F.lit(default)
    for prefix, name in reversed(rules):
        out = F.when(code.startswith(prefix), name).otherwise(out)
    return out


def rank_of(c: Column, ranks: dict[str, int] = STATUS_RANK, default: int = 0) -> Column:
    out = F.lit(default)
    for key, rank in ranks.items():
        out = F.when(c == key, rank).otherwise(out)
    return out


def split_issues(c: Column) -> Column:
    """Issue tokens of a list joined by | or ; as lower-case codes."""
    token = lambda x: F.lower(F.trim(F.regexp_replace(F.substring_index(x, ":", 1), r"[^A-Za-z0-9_.-]+", "_"), F.lit("_")))
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[|;]"), token), lambda x: x != "")


def join_codes(c: Column) -> Column:
    return F.array_join(F.array_distinct(c), "|")


def parse_grid_id(c: Column) -> Column:
    """struct(res, n, e) of ids such as 100mN12E34; other texts raise an error."""
    part = lambda i: F.regexp_extract(c, r"^(\d+)mN(-?\d+)E(-?\d+)$", i)
    good = c.rlike(r"^\d+mN-?\d+E-?\d+$")
    bad = F.raise_error(F.concat(F.lit("not a grid id: "), F.coalesce(c, F.lit("null"))))
    return F.when(good, F.struct(part(1).try_cast("int").alias("res"), part(2).try_cast("long").alias("n"), part(3).try_cast("long").alias("e"))).otherwise(bad)


def snap(v: Column, res: int) -> Column:
    return F.floor(v / res)


def grid_id_of(x: Column, y: Column, res: int) -> Column:
    return F.concat(F.lit(f"{res}mN"), snap(y, res).cast("string"), F.lit("E"), snap(x, res).cast("string"))


def centi_percent(area: Column, cell_area: float) -> Column:
    """Share of the cell in hundredths of a percent, rounded half to even, 0 .. 65535."""
    return F.least(F.greatest(F.rint(area / F.lit(cell_area) * 10000), F.lit(0.0)), F.lit(65535.0)).cast("int")


def row_fingerprint(columns: dict[str, Column]) -> Column:
    """SHA-256 of name=value pairs joined by the unit separator; nulls are empty."""
    pairs = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit(""))) for k, v in columns.items()]
    return F.sha2(F.concat_ws("\x1f", *pairs), 256)


def json_fingerprint(columns: dict[str, Column]) -> Column:
    return F.sha2(F.to_json(F.struct(*[columns[k].cast("string").alias(k) for k in sorted(columns)])), 256)


def work_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def hash_shard(c: Column, n: int) -> Column:
    """Shard by the first 8 bytes of the id's SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(n).cast("decimal(20,0)")).cast("int")


def id_from_name(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def url_extension(c: Column, fallback: str) -> Column:
    ext = F.regexp_extract(F.coalesce(F.try_parse_url(c, F.lit("PATH")), F.lit("")), r"(\.[A-Za-z0-9]{1,5})$", 1)
    return F.lower(F.when(ext != "", ext).otherwise(fallback))


def slug(c: Column, prefix: str = "") -> Column:
    """A text as a name for files, with a prefix; of a text without usable characters the prefix is left."""
    own = F.trim(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9_.-]+", "_"), F.lit("_"))
    return F.concat(F.lit(prefix), own) if prefix else own


def clean_label(c: Column) -> Column:
    t = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\s+", " ")
    return F.when(F.lower(t).isin(*NULL_WORDS), "").otherwise(t)


def month_in_window(month: Column, start: Column, end: Column) -> Column:
    """Whether a month lies in a season that may go over the end of the year; null if unknown."""
    return F.when(start <= end, month.between(start, end)).otherwise((month >= start) | (month <= end))


def expected_window(ts: Column, days: int, tz: str | None = None) -> Column:
    """struct(first, last): from the day's start some days before to the day's last hour.

    In a zone these are whole days of 24 hours before and 23 after the instant at which the day begins there, as clock times.
    """
    day = F.date_trunc("day", ts)
    if tz is None:
        return F.struct((day - F.expr(f"INTERVAL {days} DAYS")).alias("first"), (day + F.expr("INTERVAL 23 HOURS")).alias("last"))
    utc = window_hours(ts, days, tz)
    return F.struct(F.from_utc_timestamp(utc["first"], tz).alias("first"), F.from_utc_timestamp(utc["last"], tz).alias("last"))


def window_hours(ts: Column, days: int, tz: str) -> Column:
    """struct(first, last) in UTC: the hours of a clock time's window in a zone, 24 * (days + 1) of them."""
    day = to_instant(F.date_trunc("day", F.from_utc_timestamp(to_instant(ts, tz), tz)), tz)
    return F.struct((day - F.expr(f"INTERVAL {24 * days} HOURS")).alias("first"), (day + F.expr("INTERVAL 23 HOURS")).alias("last"))


def hour_series(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))


def segment_bounds(index: Column, seconds: Column) -> Column:
    return F.struct((index * seconds).alias("start"), ((index + 1) * seconds).alias("end"))


def duration_ok(c: Column, target: float, tolerance: float) -> Column:
    return F.coalesce(F.abs(c - target) <= tolerance, F.lit(False))


def valid_coordinates(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def agreement(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def to_instant(wall: Column, tz: str) -> Column:
    """UTC of a local time: the first of two where it comes twice; a time in a gap moves to the gap's end."""
    utc = F.to_utc_timestamp(wall, tz)
    back = F.from_utc_timestamp(utc, tz)
    return F.when(back == wall, utc).otherwise(F.to_utc_timestamp(F.date_trunc("hour", back), tz))


def local_parts(c: Column) -> Column:
    """struct(local, utc, date, time) of a text: its clock time without the offset, and the instant with it (UTC without one)."""
    text = F.regexp_replace(F.trim(c), "T", " ")
    bare = strip_tz(text)
    local = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")])
    sign = F.when(F.regexp_extract(text, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    part = lambda i: F.coalesce(F.regexp_extract(text, r"\d[+-](\d{2}):?(\d{2})$", i).try_cast("int"), F.lit(0))
    has_time = text.rlike(r"\d:\d{2}")
    shift = F.when(has_time, sign * (part(1) * 3600 + part(2) * 60)).otherwise(0)
    utc = F.timestamp_seconds(F.unix_timestamp(local) - shift)
    return F.struct(local.alias("local"), F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"), F.date_format(local, "yyyy-MM-dd").alias("date"), F.date_format(local, "HH:mm:ss").alias("time"))


def time_source(preferred: Column, other: Column, names: tuple[str, str], tz: str) -> Column:
    """struct(wall, source, converted, step): the first of two texts that is a local time, and where it comes from."""
    first, second = parse_walltime(preferred, tz), parse_walltime(other, tz)
    by = F.when(first.isNotNull(), names[0]).when(second.isNotNull(), names[1])
    steps = f"remove_timezone_suffix; interpret_as_{tz}_walltime; format_ISO8601"
    step = F.when(first.isNotNull(), steps).when(second.isNotNull(), f"fallback_to_{names[1]}; {steps}").otherwise("no_parseable_datetime")
    return F.struct(F.coalesce(first, second).alias("wall"), by.alias("source"), by.isNotNull().alias("converted"), step.alias("step"))


def local_year_month(ts: Column) -> Column:
    return F.struct(F.year(ts).alias("year"), F.month(ts).alias("month"))


def months_spanning(first: Column, last: Column) -> Column:
    """The distinct months, as yyyy-MM, from one time to another."""
    return F.transform(F.sequence(F.date_trunc("month", first), F.date_trunc("month", last), F.expr("INTERVAL 1 MONTH")), lambda m: F.date_format(m, "yyyy-MM"))


def duration_issue(c: Column, target: float, tolerance: float) -> Column:
    """A coded message if a duration is positive but not near the target; else null."""
    text = F.format_string(f"duration_not_{target:g}s:observed=%.6fs,allowed={target - tolerance:g}-{target + tolerance:g}s", c.cast("double"))
    return F.when((c > 0) & ~duration_ok(c, target, tolerance), text)


def valid_timestamp(local: Column, utc: Column) -> Column:
    return local.isNotNull() & utc.isNotNull()


def id_shard(c: Column, n: int) -> Column:
    """Shard of a numeric id; ids that are not numbers go by hash."""
    return F.coalesce(F.pmod(c.try_cast("bigint"), F.lit(n)).cast("int"), hash_shard(c, n))


def coded(*codes: tuple[Column, str]) -> Column:
    """The codes whose condition holds, in order, joined by |."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in codes])), "|")
