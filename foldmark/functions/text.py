"""Column functions on sequences, headers and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import SEQUENCE_ALPHABET, T7_PROMOTER, ULTIMA_BARCODE_PREFIX


def to_rna(seq: Column) -> Column:
    return F.translate(seq, "T", "U")


def to_dna(seq: Column) -> Column:
    return F.translate(seq, "U", "T")


def with_promoter(seq: Column) -> Column:
    """DNA template: the T7 promoter in front of the design."""
    return F.concat(F.lit(T7_PROMOTER), to_dna(seq))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(to_dna(seq)), "ACGT", "TGCA")


def excise_end(seq: Column, k: int) -> Column:
    """Reference without its last k nucleotides."""
    return F.substring(seq, F.lit(1), F.greatest(F.length(seq) - k, F.lit(0)))


def excise_start(seq: Column, k: int) -> Column:
    """Read without its first k nucleotides."""
    return F.substring(seq, F.lit(k + 1), F.length(seq))


def design_key(header: Column) -> Column:
    """First word of a header, slashes made underscores."""
    return F.replace(F.regexp_extract(header, r"^\s*(\S*)", 1), F.lit("/"), F.lit("_"))


def valid_alphabet(seq: Column) -> Column:
    return seq.rlike(f"^[{SEQUENCE_ALPHABET}]*$")


def trim_3prime(seq: Column, adapter: str) -> Column:
    """Sequence in front of the adapter's first exact occurrence; missing without one."""
    at = F.instr(seq, adapter)
    return F.when(at > 0, F.substring(seq, F.lit(1), at - 1))


def trim_5prime(seq: Column, adapter: str) -> Column:
    """Sequence behind the adapter's first exact occurrence; missing without one."""
    at = F.instr(seq, adapter)
    return F.when(at > 0, F.substring(seq, at + len(adapter), F.length(seq)))


def file_stem(name: Column) -> Column:
    """A figure or file name without commas, slashes, spaces and brackets."""
    s = F.regexp_replace(F.regexp_replace(name, "^_+|_+$", ""), r"[,()]", "")
    return F.trim(F.translate(s, "/ \t", "__ "))


def ultima_barcode(barcode: Column) -> Column:
    return F.concat(F.lit(ULTIMA_BARCODE_PREFIX), barcode)


def structure_map(structure: Column) -> Column:
    """1 where a dot-bracket structure is unpaired, else 0."""
    return F.transform(F.split(structure, ""), lambda c: (c == ".").cast("int"))


def pad_zeros(values: Column, size: Column) -> Column:
    """Array extended with zeros to ``size``."""
    missing = F.greatest(size - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(0).cast("bigint"), missing))


def degenerate_label(seq: Column, template: str, count: Column) -> Column:
    """Letters at the template's N positions, runs of them joined by ``_``, and the count."""
    rna, parts, last = to_rna(seq), [], None
    for i, c in enumerate(template):
        if c == "N":
            if last is not None and i > last + 1:
                parts.append(F.lit("_"))
            parts.append(F.substring(rna, i + 1, 1))
            last = i
    return F.concat(*parts, F.lit(" counts:"), count.cast("string"))


def annotations(prefix: str, design_id: Column, title: Column, author: Column, header: Column) -> Column:
    """Data annotations of a design: id, name and author, or its header when it has no id."""
    known = design_id.isNotNull()
    return F.array_compact(F.array(
        F.when(known, F.concat(F.lit(f"{prefix}:id:"), design_id.cast("bigint").cast("string"))),
        F.when(known, F.concat(F.lit(f"{prefix}:design_name:"), title)),
        F.when(known, F.concat(F.lit(f"{prefix}:author:"), author)),
        F.when(~known, F.concat(F.lit("name:"), F.translate(header, "\t", ";"))),
    ))


def fixed3(x: Column) -> Column:
    """Three decimals, as text, rounded from nine with halves away from zero; missing stays missing (blank in a CSV file)."""
    return F.round(x.cast("decimal(38,9)"), 3).cast("string")

