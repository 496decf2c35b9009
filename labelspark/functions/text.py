"""Column expressions on text. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space as word splitting sees it, with the four separator controls.
SPACE = r"(?U)[\s\x1c-\x1f]+"

# Dosage words dropped from the end of a drug name.
DOSAGE_WORDS = (
    r"USP|tablets?|capsules?|injection|solution|oral|for|"
    r"extended[- ]release|delayed[- ]release"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression that is used inside a lambda is otherwise evaluated again per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(c: Column | str) -> Column:
    """White-space separated words without empties."""
    return F.filter(F.split(_col(c), SPACE), lambda w: w != "")


def strip(c: Column | str) -> Column:
    """Both ends freed of any white space."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def n_words(c: Column | str) -> Column:
    return F.size(words(c))


def n_chars(c: Column | str) -> Column:
    return F.length(_col(c))


def squeeze(c: Column | str) -> Column:
    """Every run of white space becomes one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), SPACE, " "))


def concat_skip_null(*cols: Column | str) -> Column:
    """Concatenation that treats NULL as the empty string."""
    return F.concat(*[F.coalesce(_col(c), F.lit("")) for c in cols])


def part(c: Column | str, sep: str, i: int) -> Column:
    """The i-th piece (from 1) of a separated key."""
    return F.split_part(_col(c), F.lit(sep), F.lit(i))


def has_suffix(c: Column | str, suffix: str) -> Column:
    return F.endswith(_col(c), F.lit(suffix))


def strip_tokens(c: Column | str, *tokens: str) -> Column:
    """Remove every occurrence of each token."""
    out = _col(c)
    for token in tokens:
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def matches_any(c: Column | str, patterns: list[str]) -> Column:
    """True where one of the patterns is found, ignoring case; blanks and word edges are those of Unicode."""
    return F.rlike(_col(c), F.lit("(?iU)" + "|".join(patterns)))


def non_null_terms(*cols: Column | str) -> Column:
    """The non-null values in order, as an array."""
    return F.array_compact(F.array(*[_col(c) for c in cols]))


def url(*parts: Column | str) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _without_dosage(name: Column) -> Column:
    cut = F.regexp_replace(strip(name), rf"(?iU)([\s,]+({DOSAGE_WORDS}))+\s*$", "")
    return F.regexp_replace(cut, r"[ ,]+$", "")


def drug_name(title: Column | str) -> Column:
    """Drug name read out of a label title, at most 80 characters when guessed."""
    t = F.coalesce(_col(title), F.lit(""))
    to_use = _without_dosage(F.regexp_extract(t, r"(?iU)to use\s+(.+?)\s+safely", 1))
    info_for = _without_dosage(
        F.regexp_extract(t, r"(?iU)prescribing information for\s+(.+?)[.\n]", 1)
    )
    first = strip(F.split(t, "\n")[0])
    first = strip(F.regexp_replace(first, r"(?iU)^HIGHLIGHTS OF PRESCRIBING INFORMATION\s*", ""))
    first = strip(F.regexp_replace(first, r"(?i)^These highlights.*", ""))
    blank_to_null = [F.nullif(c, F.lit("")) for c in (to_use, info_for, F.substring(first, 1, 80))]
    return F.coalesce(*blank_to_null, F.substring(t, 1, 80))


def slug(name: Column | str, max_bytes: int = 220) -> Column:
    """File-safe key: lower case, blanks to underscores, symbols dropped, long names cut."""
    raw = _col(name)
    clean = F.regexp_replace(F.replace(F.lower(raw), F.lit(" "), F.lit("_")), r"[^\p{L}\p{N}_\-]", "")
    digest = F.md5(F.encode(raw, "UTF-8"))
    room = max_bytes - 9
    # the longest prefix that fits has between room/4 and room characters
    lengths = F.sequence(F.lit(room // 4), F.lit(room))

    def shortened(clean: Column) -> Column:
        fitting = F.filter(lengths, lambda n: F.octet_length(F.substring(clean, F.lit(1), n)) <= room)
        cut = F.substring(clean, F.lit(1), F.array_max(fitting))
        return (
            F.when(F.octet_length(clean) > max_bytes, F.concat(cut, F.lit("_"), F.substring(digest, 1, 8)))
            .when(clean == "", F.concat(F.lit("medicine_"), F.substring(digest, 1, 12)))
            .otherwise(clean)
        )

    return let(clean, shortened)
