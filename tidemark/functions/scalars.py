"""Scalar Column expressions (F1-F10, F16-F18). All are JVM built-ins, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the published format.
KEY_DIGITS = 9  # row keys are zero-padded to at least nine digits
FAMILY = "mysql"  # column family prefix of published cells
DUMP_DONE_MARK = "Dump completed on "  # text of the last mysqldump line before its date
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def line_md5(value) -> Column:
    """md5 of a dump line as read from the file (the newline the text scan removed is put back)."""
    return F.md5(F.concat(_c(value), F.lit("\n")))


def zero_pad(key) -> Column:
    """left-pad to KEY_DIGITS with zeros, never truncating longer keys (plain lpad truncates). A key with other
    characters than digits is kept as it is."""
    s = _c(key).cast("string")
    return F.when(s.rlike("[^0-9]"), s).otherwise(F.lpad(s, F.greatest(F.lit(KEY_DIGITS), F.length(s)), "0"))


def key_hash(*columns) -> Column:
    """A 64-bit hash that goes before text keys in grouping and joining: sorts compare eight bytes first, and padded keys share
    theirs, so that nearly every comparison would read both keys whole."""
    return F.xxhash64(*[_c(c) for c in columns])


def seldom(value, rare) -> Column:
    """``rare`` of a value, kept out of the code generated around it: the JVM leaves methods beyond 8,000 bytes of code
    uncompiled, with the common case in them."""
    return F.transform(F.array(_c(value)), rare)[0]


def unpad(key) -> Column:
    """drop the zero padding of an integer key; non-integer keys become null."""
    return _c(key).try_cast("bigint").cast("string")


def dump_time_epoch(line, tz: str = "UTC") -> Column:
    """F8: epoch seconds of a 'Dump completed on Y-m-d H:M:S' line, null if the line has no such date.

    mysqldump pads a one-digit hour with a space, so runs of blanks are collapsed first. The wall clock is read in
    ``tz`` (explicit, instead of the machine's zone)."""
    text = F.regexp_replace(_c(line), r"\s+", " ")
    rx = r"Dump completed on (\d{4}-\d{2}-\d{2}) (\d{1,2}):(\d{2}):(\d{2})"
    day = F.try_to_date(F.regexp_extract(text, rx, 1), "yyyy-MM-dd")
    secs = (
        F.unix_date(day).cast("bigint") * 86400
        + F.regexp_extract(text, rx, 2).try_cast("bigint") * 3600
        + F.regexp_extract(text, rx, 3).try_cast("bigint") * 60
        + F.regexp_extract(text, rx, 4).try_cast("bigint")
    )
    out = F.when(text.rlike(rx), secs)
    if tz != "UTC":
        wall = F.timestamp_seconds(out).cast("timestamp_ntz")
        out = F.unix_seconds(F.to_utc_timestamp(wall.cast("timestamp"), tz))
    return out


def forced_date_epoch(date_text) -> Column:
    """'Y-m-d' (the forced dump date) to epoch seconds at midnight UTC; null when not a date."""
    return F.unix_date(F.try_to_date(_c(date_text), "yyyy-MM-dd")).cast("bigint") * 86400


def epoch_iso(epoch) -> Column:
    """epoch seconds to 'yyyy-MM-dd HH:mm:ss' (UTC wall clock, independent of the session zone)."""
    return F.date_format(
        F.timestamp_add("SECOND", _c(epoch).cast("bigint"), F.expr(EPOCH_NTZ)), "yyyy-MM-dd HH:mm:ss"
    )


def ntz_micros(ts) -> Column:
    """Microseconds since epoch of a TIMESTAMP_NTZ (wall clock taken as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(ts))


def qualified(column) -> Column:
    """F16 / P11: 'family:column' cell name."""
    return F.concat(F.lit(FAMILY + ":"), _c(column))


def bare(column) -> Column:
    """Inverse of ``qualified``."""
    return F.regexp_replace(_c(column), "^" + FAMILY + ":", "")


def round1(x) -> Column:
    """elapsed seconds rounded to one decimal."""
    return F.round(_c(x), 1)
