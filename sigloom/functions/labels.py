"""Names, classes, identifiers and header fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(name: Column) -> Column:
    """Without surrounding blanks and NULs."""
    return F.trim(F.regexp_replace(name, "\\x00+$", ""))


def channel_key(name: Column, rate: Column) -> Column:
    return F.concat_ws("-", clean(name), F.format_string("%s", rate))


def default_label(electrode: Column) -> Column:
    """chanN for electrodes up to 128, ainpN for those beyond."""
    return F.when(electrode < 129, F.concat(F.lit("chan"), electrode.cast("string"))).otherwise(F.concat(F.lit("ainp"), (electrode - 128).cast("string")))


def unit_class(unit: Column) -> Column:
    """Unit 0 is unclassified, 1 to 16 sorted units, 255 noise; others are errors."""
    return F.when(unit == 0, F.lit("unclassified")).when(unit.between(1, 16), unit.cast("string")).when(unit == 255, F.lit("noise")).otherwise(F.raise_error(F.concat(F.lit("no such unit: "), unit.cast("string"))).cast("string"))


def packet_class(packet_id: Column, spikes_to: int = 2048) -> Column:
    """Packets by id: 0 events, 1 to spikes_to spikes, 0xFFFB to 0xFFFF the special ones."""
    names = {0xFFFF: "continuation", 0xFFFE: "button trigger", 0xFFFD: "tracking", 0xFFFC: "video sync", 0xFFFB: "comment"}
    out = F.when(packet_id == 0, F.lit("event")).when(packet_id.between(1, spikes_to), F.lit("spike"))
    for k, v in names.items():
        out = out.when(packet_id == k, F.lit(v))
    return out.otherwise(F.lit("unknown"))


def guid(hex32: Column) -> Column:
    """Sixteen stored bytes (as hex) to {8-4-4-4-12}: the first three groups have their bytes reversed."""
    b = lambda i: F.substring(hex32, 2 * i + 1, 2)
    part = lambda ids: F.concat(*[b(i) for i in ids])
    return F.upper(F.concat(F.lit("{"), part([3, 2, 1, 0]), F.lit("-"), part([5, 4]), F.lit("-"), part([7, 6]), F.lit("-"), part([8, 9]), F.lit("-"), part(range(10, 16)), F.lit("}")))


def named(key: Column, names: dict[str, str], default: str = "UNKNOWN") -> Column:
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default)) if pairs else F.lit(default)


def sample_format(code: Column) -> Column:
    """Bytes per value of a stored format: 4 or 3; bit 0x80 marks composites; other codes fail."""
    base = code.bitwiseAND(0x7F)
    return F.when(base == 4, 4).when(base == 5, 3).otherwise(F.raise_error(F.concat(F.lit("unsupported format: "), code.cast("string"))).cast("int"))


def is_composite(code: Column) -> Column:
    return code.bitwiseAND(0x80) != 0


def value_type(fmt: Column, n_bytes: Column) -> Column:
    """Storage type of (format, bytes): integers of 4 and 3 bytes, floats of 4."""
    return F.when((fmt == "int") & (n_bytes == 4), F.lit("int32")).when((fmt == "int") & (n_bytes == 3), F.lit("int24")).when((fmt == "float") & (n_bytes == 4), F.lit("float32")).otherwise(F.raise_error(F.lit("unsupported sample type")).cast("string"))


def segment_number(name: Column) -> Column:
    """The number in a -NNNNNN suffix."""
    return F.regexp_extract(name, "-(\\d{6})", 1).try_cast("int")


def chunk_parts(name: Column) -> Column:
    """start, flag and suffix of a chunk file's name: <anything>_<start>_<flag>_<suffix>."""
    p = F.split(F.regexp_replace(name, "\\.[^.]*$", ""), "_")
    at = lambda i: F.try_element_at(p, F.lit(i))
    return F.struct(at(-3).try_cast("long").alias("start"), at(-2).try_cast("int").alias("flag"), at(-1).alias("suffix"))


def header_map(header: Column) -> Column:
    """'a = 1; b = 2' headers to a map."""
    text = F.regexp_replace(F.regexp_replace(header, "header\\.", ""), "['\\n]", "")
    pairs = F.filter(F.split(text, ";"), lambda x: F.contains(x, F.lit(" = ")))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit(" = "), F.lit(1))), F.trim(F.split_part(x, F.lit(" = "), F.lit(2))))))


def file_kind(name: Column, description: Column) -> Column:
    """What a recording file holds, by its name and header: skip, continuous, spike, event; others fail."""
    d = F.lower(description)
    return (
        F.when(name.endswith(".openephys") | name.endswith(".events"), F.lit("skip"))
        .when(F.contains(d, F.lit("continuous")) | F.contains(d, F.lit("record contains one 64-bit timestamp, one 16-bit")), F.lit("continuous"))
        .when(F.contains(d, F.lit("spike")), F.lit("spike"))
        .when(F.contains(d, F.lit("event")), F.lit("event"))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported file: "), name)).cast("string"))
    )


def xml_text(xml: Column, path: str) -> Column:
    return F.xpath_string(xml, F.lit(path))


def all_equal(xml: Column, path: str) -> Column:
    """The one value that all nodes of the path have; fails if they differ."""
    found = F.array_distinct(F.xpath(xml, F.lit(path)))
    return F.when(F.size(found) == 1, found[0]).otherwise(F.raise_error(F.lit("mixed values")).cast("string"))


def upload_key(directory: Column, user: Column, job: Column, file: Column) -> Column:
    """directory/file, or user/exports/job/file; without a user the job's id stands for it."""
    return F.when(directory.isNotNull(), F.concat_ws("/", directory, file)).otherwise(F.concat_ws("/", F.coalesce(user, job), F.lit("exports"), job, file))
