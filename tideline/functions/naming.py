"""Names and positions: identifier sanitising, topic and subject names, log sequence numbers.

Each function on plain strings has a column counterpart built from SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_TOPIC = 256
DEFAULT_SCHEMA = "public"
#: Microseconds from 1970-01-01 to 2000-01-01, the origin of the source's clock.
CLOCK_ORIGIN_MICROS = 946_684_800_000_000


class TopicNameTooLong(ValueError):
    pass


def sanitise(name: str, namespace: bool = False) -> str:
    """Letters, ``_`` and non-leading digits stay; every other UTF-8 byte becomes ``_hh_``.

    In a namespace, dots between other characters stay as well.
    """
    raw = name.encode("utf-8")
    out = []
    for i, byte in enumerate(raw):
        c = chr(byte)
        letter = c == "_" or (c.isascii() and c.isalpha())
        digit = c.isascii() and c.isdigit() and i > 0
        dot = namespace and c == "." and 0 < i < len(raw) - 1
        out.append(c if letter or digit or dot else f"_{byte:02x}_")
    return "".join(out)


def sanitise_column(name: Column, namespace: bool = False) -> Column:
    latin = F.decode(F.encode(name, "UTF-8"), "ISO-8859-1")  # one character a byte
    last = F.length(latin) - 1

    def safe(c: Column, i: Column) -> Column:
        fine = c.rlike("^[A-Za-z_]$") | ((i > 0) & c.rlike("^[0-9]$"))
        if namespace:
            fine = fine | ((c == ".") & (i > 0) & (i < last))
        return F.when(fine, c).otherwise(F.concat(F.lit("_"), F.lower(F.hex(F.encode(c, "ISO-8859-1"))), F.lit("_")))

    chars = F.filter(F.split(latin, ""), lambda c: c != "")
    return F.when(name == "", name).otherwise(F.array_join(F.transform(chars, safe), ""))


def topic_name(table: str, schema: str | None = None, prefix: str | None = None) -> str:
    """``[prefix.][schema.]table``; the default schema is left out. Too long a name raises."""
    parts = [prefix or None, None if schema in (None, "", DEFAULT_SCHEMA) else sanitise(schema), sanitise(table)]
    topic = ".".join(p for p in parts if p)
    if len(topic) > MAX_TOPIC:
        raise TopicNameTooLong(f"topic name of {len(topic)} characters, at most {MAX_TOPIC} are allowed: {topic[:40]}...")
    return topic


def topic_column(table: Column, schema: Column | None = None, prefix: str | None = None) -> Column:
    parts = [F.lit(prefix)] if prefix else []
    if schema is not None:
        parts.append(F.when(~schema.isin("", DEFAULT_SCHEMA), sanitise_column(schema)))
    return F.concat_ws(".", *parts, sanitise_column(table))


def checked_topic(topic: Column) -> Column:
    """The topic, or a failing query where the name is too long."""
    return F.when(F.length(topic) <= MAX_TOPIC, topic).otherwise(F.raise_error(F.concat(F.lit("topic name too long: "), topic)))


def subject_name(topic: str, part: str) -> str:
    if part not in ("key", "value"):
        raise ValueError(f"a subject is for a key or a value, not {part!r}")
    return f"{topic}-{part}"


def subject_column(topic: Column, part: str) -> Column:
    return F.concat(topic, F.lit(subject_name("", part)))


def quote_identifier(schema: str, table: str, quote: str = '"') -> str:
    return ".".join(quote + x.replace(quote, quote * 2) + quote for x in (schema, table))


def split_option(text: str) -> tuple[str, str]:
    """``key=value`` at the first equals sign."""
    key, sign, value = text.partition("=")
    if not sign or not key:
        raise ValueError(f"expected key=value, got {text!r}")
    return key, value


def parse_lsn(text: str) -> int:
    high, sign, low = text.partition("/")
    if not sign:
        raise ValueError(f"not a log position: {text!r}")
    value = (int(high, 16) << 32) + int(low, 16)
    if len(high) > 8 or len(low) > 8:
        raise ValueError(f"not a log position: {text!r}")
    return value


def format_lsn(lsn: int) -> str:
    lsn %= 1 << 64
    return f"{lsn >> 32:X}/{lsn & 0xFFFFFFFF:X}"


def parse_lsn_column(text: Column) -> Column:
    """As a signed long; positions of 2**63 and more wrap to negative numbers."""
    part = lambda i: F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("long")
    return F.shiftleft(part(1), 32).bitwiseOR(part(2))


def format_lsn_column(lsn: Column) -> Column:
    lsn = lsn.cast("long")
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF))))


def big_endian(x: Column, width: int = 8) -> Column:
    """Network byte order of an integer, ``width`` bytes."""
    return F.unhex(F.right(F.lpad(F.hex(x.cast("long")), 16, "0"), F.lit(2 * width)))


def source_clock(ts: Column) -> Column:
    """Microseconds since 2000-01-01 of a timestamp."""
    return F.unix_micros(ts.cast("timestamp")) - F.lit(CLOCK_ORIGIN_MICROS)


def partition_column(key: Column, partitions: int, spread: list[Column]) -> Column:
    """CRC-32 of the key bytes; rows without a key are spread by a hash of ``spread``.

    The hash stands for the random choice: recomputed tasks choose the same partition.
    """
    keyed = F.pmod(F.crc32(key.cast("binary")), F.lit(partitions))
    loose = F.pmod(F.xxhash64(*spread), F.lit(partitions))
    return F.when(key.isNotNull(), keyed).otherwise(loose).cast("int")
