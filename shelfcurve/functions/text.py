"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Legal-form suffixes in brand names, each with its leading space.
LEGAL_FORMS = (" ооо", " оао", " кк", " мк")
# The Latin letter and the Cyrillic letter that replaces it.
LATIN_C, CYRILLIC_ES = "c", "с"
# What counts as the end of a line.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def normalise_brand(name: Column) -> Column:
    """Lower case, one spelling of the letter с, no legal form."""
    spelled = F.translate(F.lower(name), LATIN_C, CYRILLIC_ES)
    return reduce(lambda text, form: F.replace(text, F.lit(form), F.lit("")), LEGAL_FORMS, spelled)


def replace_all(text: Column, replacements: dict[str, str]) -> Column:
    """Replace plain substrings, one after the other."""
    return reduce(
        lambda done, pair: F.replace(done, F.lit(pair[0]), F.lit(pair[1])), replacements.items(), text
    )


def rotate_first_word(text: Column) -> Column:
    """Move the first word to the end.

    Without a space the result is the text, a space and the text without its last letter.
    """
    space = F.instr(text, " ")
    rest = F.substring(text, space + 1, F.length(text))
    head_length = F.when(space > 0, space - 1).otherwise(F.greatest(F.length(text) - 1, F.lit(0)))
    return F.concat(rest, F.lit(" "), F.substring(text, F.lit(1), head_length))


def name_part(name: Column, from_right: int) -> Column:
    """Part of a dotted name counted from the right; NULL if there is none."""
    return F.nullif(F.split_part(name, F.lit("."), F.lit(-from_right)), F.lit(""))


def common_name(entry: Column) -> Column:
    """Text between ``CN=`` and the next comma; NULL if there is none."""
    return F.nullif(F.regexp_extract(entry, r"CN=([^,]+),", 1), F.lit(""))


def strip_line_breaks(text: Column) -> Column:
    """Remove line breaks, real ones and written escapes, from the end of a name."""
    return F.regexp_replace(text, r"(\\r|\\n|\r|\n)+$", "")


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.contains(F.lower(text), F.lit(part.lower()))


def every_nth_word(text: Column, step: int = 2) -> Column:
    """Keep the words at positions 0, step, 2*step, ..."""
    words = F.filter(F.split(text, r"\s+"), lambda word: word != "")
    return F.array_join(F.filter(words, lambda _, i: i % step == 0), " ")


def swap_pair(line: Column, separator: str = "--") -> Column:
    """``left -- right`` becomes ``right -- left``."""
    left = F.trim(F.split_part(line, F.lit(separator), F.lit(1)))
    right = F.trim(F.split_part(line, F.lit(separator), F.lit(2)))
    return F.concat_ws(f" {separator} ", right, left)


def first_titles(feed: Column, count: int = 6) -> Column:
    """Titles of the first entries of a JSON feed."""
    schema = "struct<feed: struct<entry: array<struct<title: struct<`$t`: string>>>>>"
    entries = F.from_json(feed, schema)["feed"]["entry"]
    return F.transform(F.slice(entries, 1, count), lambda entry: entry["title"]["$t"])


def paragraph_body(text: Column) -> Column:
    """A notebook paragraph without its first line; NULL if nothing is left."""
    lines = F.regexp_replace(F.regexp_replace(text, LINE_BREAK, "\n"), r"\n\z", "")
    first_break = F.instr(lines, "\n")
    return F.when(first_break > 0, F.substring(lines, first_break + 1, F.length(lines)))
