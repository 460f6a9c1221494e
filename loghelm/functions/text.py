"""Column functions that turn a raw log line into structured fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line shapes, token patterns and keyword lists of the log format.
# (?U) gives \d \w \s \b their Unicode meaning, (?d) lets '.' stop at LF only.
HDFS_LINE = r"(?Ud)^(\d{6})\s+(\d{6})\s+(\d+)\s+([A-Z]+)\s+([\w.$]+):\s+(.*)$"
STANDARD_LINE = (
    r"(?Ud)^(\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?)"
    r"\s+\[([A-Z]+)\]\s+\[([\w.\-]+)\]:\s+(.*)$"
)
STANDARD_LINE_WITH_OFFSET = (
    r"(?Ud)^(\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?)"
    r"\s+\[([A-Z]+)\]\s+\[([\w.\-]+)\]:\s+(.*)$"
)
HDFS_SEPARATOR = r"(?U)\s+"
STANDARD_SEPARATOR = r"(?U)\s+\[|\]\s+\[|\]:\s+"
BLOCK_ID = r"blk_[-0-9]+"
IP_ADDRESS = r"(?U)/(?:\d{1,3}\.){3}\d{1,3}(?::\d+)?"
HEX_NUMBER = r"0x[0-9a-fA-F]+"
PLAIN_NUMBER = r"(?U)\b\d+\b"
SPACE = r"[\s\x1c-\x1f]"
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ALERT_WORDS = ("outofmemory", "hikaripool", "nullpointer", "panic", "deadlock", "timeout", "critical")
HIGHLIGHT_WORDS = ("outofmemory", "hikaripool", "nullpointer", "panic", "deadlock", "error", "critical")

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """No character other than white space."""
    return strip(text) == ""


def drop_undecodable(text: Column) -> Column:
    """Leave out bytes that are no UTF-8; valid text, U+FFFD included, stays."""
    repaired = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def sanitize(message: Column) -> Column:
    """Replace block ids, addresses, hex and stand-alone numbers by placeholders."""
    out = F.regexp_replace(message, BLOCK_ID, "<BLOCK>")
    out = F.regexp_replace(out, IP_ADDRESS, "<IP>")
    out = F.regexp_replace(out, HEX_NUMBER, "<HEX>")
    out = F.regexp_replace(out, PLAIN_NUMBER, "<NUM>")
    return strip(out)


def block_id(message: Column) -> Column:
    """First block id in the text, or NULL."""
    return F.nullif(F.regexp_extract(message, BLOCK_ID, 0), F.lit(""))


def log_id(line_no: Column) -> Column:
    return F.format_string("log_%07d", line_no)


def has_any_word(text: Column, words: tuple[str, ...] = ALERT_WORDS) -> Column:
    """Case-insensitive containment of any of the words."""
    return F.lower(text).rlike("|".join(words))


def encode_label(label: Column) -> Column:
    """Anomaly 1, Normal 0, everything else -1."""
    return F.when(label == "Anomaly", 1).when(label == "Normal", 0).otherwise(-1)


def parse_lines(
    lines: DataFrame,
    value: str = "value",
    ingest_ts: Column | None = None,
    accept_offsets: bool = False,
) -> DataFrame:
    """Add the parsed fields to a table of lines; blank lines must be gone.

    Row-local and free of Python, so batch and stream share it and column
    pruning removes the extractions nobody asks for. Lines without a usable
    timestamp get `ingest_ts` (default: the start of the query) as text and a
    NULL `event_ts`.
    """
    standard = STANDARD_LINE_WITH_OFFSET if accept_offsets else STANDARD_LINE
    shaped = lines.withColumns(
        {"raw_text": strip(F.col(value)), "__ingest": F.current_timestamp() if ingest_ts is None else ingest_ts}
    ).withColumn(
        "format",
        F.expr(
            f"CASE WHEN raw_text RLIKE r'{HDFS_LINE}' THEN 'hdfs' "
            f"WHEN raw_text RLIKE r'{standard}' THEN 'standard' ELSE 'raw' END"
        ),
    )
    # The shape is known, so one split at its separators yields all fields:
    # date, time, pid, level, component, message; or time, level, source, message.
    split = shaped.withColumn(
        "__f",
        F.expr(
            f"CASE format WHEN 'hdfs' THEN split(raw_text, r'{HDFS_SEPARATOR}', 6) "
            f"WHEN 'standard' THEN split(raw_text, r'{STANDARD_SEPARATOR}', 4) END"
        ),
    ).withColumn("__ts", F.expr("try_to_timestamp(if(format = 'hdfs', concat('20', __f[0], __f[1]), NULL), 'yyyyMMddHHmmss')"))
    by_shape = "CASE format WHEN 'hdfs' THEN {} WHEN 'standard' THEN {} ELSE {} END"
    fallback = f'date_format(__ingest, "{ISO_MICROS}")'
    hdfs_text = f'coalesce(date_format(__ts, "{ISO_SECONDS}"), {fallback})'
    fields = split.withColumns(
        {
            "timestamp": F.expr(by_shape.format(hdfs_text, "__f[0]", fallback)),
            "event_ts": F.expr(by_shape.format("__ts", "try_cast(__f[0] AS TIMESTAMP)", "NULL")),
            "level": F.expr(by_shape.format("__f[3]", "__f[1]", "'INFO'")),
            "source": F.expr(by_shape.format("substring_index(__f[4], ':', 1)", "__f[2]", "'unknown'")),
            "message": F.expr(by_shape.format("__f[5]", "__f[3]", "raw_text")),
        }
    )
    parsed = fields.withColumns({"template": sanitize(F.col("message")), "block_id": block_id(F.col("message"))})
    return parsed.drop("__ingest", "__f", "__ts")
