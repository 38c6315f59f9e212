"""Scalar functions on sequences, identifiers and scores, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixframe.schemas import ALPHABET, EVALUE_FLOOR, RARE_RESIDUES


def letters(seq: Column) -> Column:
    """The characters of a sequence; an empty one has none."""
    return F.filter(F.split(seq, ""), lambda c: c != "")


def distinct_letters(seq: Column) -> Column:
    return F.size(F.array_distinct(letters(seq)))


def normalise_residues(seq: Column) -> Column:
    """Upper case, rare residues as X."""
    return F.regexp_replace(F.upper(seq), f"[{RARE_RESIDUES}]", "X")


def translation_prompt(seq: Column) -> Column:
    """Spaced residues behind the direction tag of a translation to structure letters."""
    return F.concat(F.lit("<AA2fold> "), F.array_join(letters(seq), " "))


def tag_by_case(seq: Column) -> Column:
    """The direction tag by case: all upper means residues, else structure letters."""
    upper = (seq == F.upper(seq)) & (seq != F.lower(seq))
    return F.concat(F.when(upper, "<AA2fold>").otherwise("<fold2AA>"), F.lit(" "), seq)


def decoded(seq: Column) -> Column:
    """Model output as a sequence: no spaces, lower case."""
    return F.lower(F.replace(seq, F.lit(" "), F.lit("")))


def log_evalue(evalue: Column) -> Column:
    """log10 of an e-value that is held above the smallest one told apart."""
    return F.log10(F.greatest(evalue, F.lit(EVALUE_FLOOR)))


def short_label(name: Column, width: int = 15) -> Column:
    return F.substring(name, 1, width)


#: The forms of an accession in a sequence name, the first that fits wins.
ACCESSION_FORMS = (r"[st][pr]\|([A-Za-z0-9]+)\|", r"AF-([A-Za-z0-9]+)-F", r"\b([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9](?:[A-Z][A-Z0-9]{2}[0-9]){1,2})\b")


def protein_accession(name: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(name, form, 1), F.lit("")) for form in ACCESSION_FORMS])


def conservation(entropy: Column) -> Column:
    """1 for a column of one letter, 0 for all twenty alike."""
    return F.least(F.greatest(F.lit(1.0) - entropy / F.log2(F.lit(20.0)), F.lit(0.0)), F.lit(1.0))


def rgb(score: Column) -> Column:
    """Blue over white to red for 0 to 1, as red, green, blue from 0 to 1."""
    high, t_high, t_low = score >= 0.5, (score - 0.5) * 2, score * 2
    one = F.lit(1.0)
    fade = F.when(high, one - t_high).otherwise(t_low)
    return F.struct(F.when(high, one).otherwise(t_low).alias("r"), fade.alias("g"), F.when(high, one - t_high).otherwise(one).alias("b"))


def hex_colour(score: Column) -> Column:
    """rgb as 0xrrggbb, each part cut to a whole number."""
    part = lambda x: F.lpad(F.lower(F.hex(F.floor(x * 255).cast("long"))), 2, "0")
    c = rgb(score)
    return F.concat(F.lit("0x"), part(c["r"]), part(c["g"]), part(c["b"]))


def percent_bucket(pct: Column) -> Column:
    """100%, 0%, or the ten a percentage is in."""
    low = (F.floor(pct / 10) * 10).cast("int")
    return F.when(pct == 100, "100%").when(pct == 0, "0%").otherwise(F.concat(low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit("%")))


def fit_length(seq: Column, length: Column) -> Column:
    """Cut or padded with gaps to a length."""
    return F.rpad(F.substr(seq, F.lit(1), length), length, F.lit("-"))


def foreign_letters(seq: Column) -> Column:
    """Sorted letters outside the alphabet, joined."""
    return F.array_join(F.sort_array(F.array_except(F.array_distinct(letters(seq)), F.array(*[F.lit(c) for c in ALPHABET]))), "")


def natural_number(name: Column) -> Column:
    """The last run of digits in a file name, 0 without one."""
    runs = F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1))
    return F.coalesce(F.try_element_at(runs, F.lit(-1)).cast("long"), F.lit(0))
