"""Column functions on text: tokens, path and message rules, Markdown features, versions, redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning in titles.
STOP_WORDS = ["the", "and", "for", "with", "from", "this", "that", "into", "add", "fix", "use", "update", "remove"]

# Path rules, first to last.
PATH_RULES = {
    "test": r"(^|/)(tests?|spec|__tests__)(/|$)|(_test|\.test|\.spec)\.",
    "docs": r"(^|/)docs?(/|$)|\.(md|rst|txt)$",
    "generated": r"(^|/)(vendor|dist|generated|node_modules)(/|$)|\.min\.",
    "migration": r"(^|/)migrations?(/|$)",
    "auth": r"auth|login|permission|secur",
    "config": r"\.(ya?ml|toml|ini|cfg)$|(^|/)config(/|$)",
}

# Secrets that are blanked, in order.
SECRET_RULES = [
    (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "[private key]"),
    (r"\bgh[pousr]_[A-Za-z0-9]{20,}\b", "[token]"),
    (r"\bAKIA[0-9A-Z]{16}\b", "[access key]"),
    (r"(?i)\b(password|passwd|secret|token)(\s*[:=]\s*)\S+", "$1$2[secret]"),
]


def tokens(*texts: Column) -> Column:
    """Sorted distinct words ``[a-z][a-z0-9_]{2,}`` of the texts without stop words; nulls count as empty."""
    whole = F.lower(F.concat_ws(" ", *texts))
    return F.array_sort(F.array_except(F.array_distinct(F.regexp_extract_all(whole, F.lit("([a-z][a-z0-9_]{2,})"), 1)), F.array(*map(F.lit, STOP_WORDS))))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; null if both are empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def path_flags(path: Column) -> dict[str, Column]:
    return {f"is_{name}": path.rlike(f"(?i){rule}") for name, rule in PATH_RULES.items()}


def is_word_in(text: Column, *words: str) -> Column:
    """True where one of the words stands alone, whatever its case; null text is false."""
    return F.coalesce(text.rlike(rf"(?i)(?<![a-z0-9_])({'|'.join(words)})(?![a-z0-9_])"), F.lit(False))


def subsystem(path: Column) -> Column:
    """First part of a path, first two below four parts or more; null for a bare name."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 4, F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).when(F.size(parts) >= 2, F.get(parts, F.lit(0)))


def body_features(body: Column) -> dict[str, Column]:
    """Markdown features of a description; null counts as empty."""
    b = F.coalesce(body, F.lit(""))
    return {
        "has_linked_issue": b.rlike(r"(?i)\b(close[sd]?|fix(e[sd])?|resolve[sd]?)\s+#[0-9]+"),
        "n_headings": F.regexp_count(b, F.lit(r"(?m)^#{1,6} ")),
        "n_checklist": F.regexp_count(b, F.lit(r"(?m)^\s*[-*] \[[ xX]\]")),
        "n_links": F.regexp_count(b, F.lit(r"https?://")),
    }


def folder_version_key(version: Column) -> Column:
    """Parts of a folder's version in an order where numbers compare as numbers, and before text."""
    return F.transform(
        F.split(version, r"[.\-+]"),
        lambda p: F.struct((~p.rlike("^[0-9]+$")).alias("is_text"), F.coalesce(p.try_cast("long"), F.lit(0)).alias("number"), F.when(~p.rlike("^[0-9]+$"), p).otherwise("").alias("text")),
    )


def version_key(version: Column) -> Column:
    """A release's place: all numbers of its core without trailing zeros, then pre-releases before the release, part by
    part, numbers before text. Build data (+...) doesn't count; a version without a number is null."""
    whole = F.regexp_replace(version, r"\+.*$", "")
    core, pre = F.regexp_extract(whole, "^([^-]*)", 1), F.regexp_extract(whole, "^[^-]*-(.*)$", 1)
    numbers = F.transform(F.regexp_extract_all(core, F.lit("([0-9]+)"), F.lit(1)), lambda n: n.cast("long"))
    last = F.coalesce(F.array_max(F.transform(numbers, lambda n, i: F.when(n > 0, i + 1))), F.lit(1))
    parts = F.transform(
        F.filter(F.split(pre, r"[.\-]"), lambda p: p != ""),
        lambda p: F.struct((~p.rlike("^[0-9]+$")).alias("is_text"), F.coalesce(p.try_cast("long"), F.lit(0)).alias("number"), F.when(~p.rlike("^[0-9]+$"), p).otherwise("").alias("text")),
    )
    return F.when(F.size(numbers) > 0, F.struct(F.slice(numbers, F.lit(1), last).alias("core"), (pre == "").alias("is_release"), parts.alias("pre")))


def version_in_range(version: Column, wanted: str) -> Column:
    """Whether a version meets all comma-separated bounds (<, <=, >, >=, = and a version); null if it has no number."""
    out, own = F.lit(True), version_key(version)
    for bound in wanted.split(","):
        sign, other = bound.split()
        key = version_key(F.lit(other))
        out = out & {"<": own < key, "<=": own <= key, ">": own > key, ">=": own >= key, "=": own == key}[sign]
    return out


def duration(seconds: Column) -> Column:
    """Whole seconds in their two largest units: 42s, 3m 5s, 2h 10m, 4d 7h."""
    parts = {86_400: ("d", 3600, "h"), 3600: ("h", 60, "m"), 60: ("m", 1, "s")}
    out = F.concat(seconds, F.lit("s"))
    for size, (unit, small, name) in reversed(parts.items()):
        out = F.when(seconds >= size, F.concat(F.floor(seconds / size), F.lit(f"{unit} "), F.floor(seconds % size / small), F.lit(name))).otherwise(out)
    return out


def log_level(line: Column) -> Column:
    """Level of a log line by the first rule that matches; null if none does."""
    return (
        F.when(line.rlike(r"(?i)\b(error|fatal|exception|traceback)\b"), "error")
        .when(line.rlike(r"(?i)\bwarn(ing)?\b"), "warn")
        .when(line.rlike(r"(?i)\binfo\b"), "info")
        .when(line.rlike(r"(?i)\bdebug\b"), "debug")
    )


def redact(text: Column) -> Column:
    for pattern, to in SECRET_RULES:
        text = F.regexp_replace(text, pattern, to)
    return text


def contains_pattern(column: Column, text: str) -> Column:
    """Case-insensitive contains; % and _ of the text stay wildcards."""
    return column.cast("string").ilike(f"%{text}%")


def contains_literal(column: Column, text: str) -> Column:
    """Contains, with % and _ taken as they are."""
    return F.contains(column.cast("string"), F.lit(text))
