"""Scalar string / number / array / JSON expressions.

Every function maps Columns to a Column with built-in expressions (regex,
higher-order array functions, ``try_cast``), so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


_INT_RE = r"^\s*[+-]?[0-9]+\s*$"

# Fixed value: weekday list used when a stored list has no valid entry.
DEFAULT_WEEKDAYS = (0, 2, 4)


def parse_weekdays(text) -> Column:
    """Comma list -> ``ARRAY<INT>``; invalid parts skipped; empty -> [0, 2, 4]."""
    parts = F.filter(F.split(F.coalesce(_c(text), F.lit("")), ","), lambda x: x.rlike(_INT_RE))
    vals = F.transform(parts, lambda x: F.trim(x).cast("int"))
    return F.when(F.size(vals) == 0, F.array(*[F.lit(d) for d in DEFAULT_WEEKDAYS])).otherwise(vals)


def sanitize_weekdays(arr) -> Column:
    """Keep 0..6, distinct, sorted."""
    return F.sort_array(F.array_distinct(F.filter(_c(arr), lambda d: (d >= 0) & (d <= 6))))


def safe_int(x) -> Column:
    """``max(0, int(float(x)))``; unparsable, NaN or infinite -> 0 (truncates toward zero)."""
    d = F.trim(_c(x)).try_cast("double")
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(9.2e18))
    return F.when(ok, F.greatest(F.lit(0), d.cast("long"))).otherwise(F.lit(0))


def safe_float(x: str) -> Column:
    """Empty or unparsable -> NULL."""
    return F.expr(f"try_cast(nullif(trim({x}), '') AS DOUBLE)")


def parse_iso(x) -> Column:
    """ISO timestamp (optional trailing Z), else the first 10 characters as a date."""
    s = F.regexp_replace(_c(x), "Z$", "")
    ts = F.try_to_timestamp(s)
    return F.coalesce(ts.cast("timestamp_ntz"), F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd"))
                      .cast("timestamp_ntz"))


def epley(weight, reps) -> Column:
    """Estimated one-rep max: w * (1 + max(1, reps) / 30)."""
    return _c(weight) * (F.lit(1.0) + F.greatest(F.lit(1), _c(reps)) / 30.0)


def round_load(x, step: float = 2.5, floor: bool = False) -> Column:
    """Nearest multiple of ``step`` (half-even, as the plate rule), at least 0; ``floor`` rounds down."""
    q = _c(x) / step
    r = F.floor(q) if floor else F.bround(q, 0)
    return F.greatest(F.lit(0.0), r * step)


def load_for_reps(e1rm, reps, step: float = 2.5) -> Column:
    """Inverse Epley, rounded to the plate step."""
    return round_load(_c(e1rm) / (F.lit(1.0) + F.greatest(F.lit(1), _c(reps)) / 30.0), step)


def slot_score(load) -> Column:
    return F.greatest(F.lit(0.0), F.lit(100.0) - _c(load))


def name_key(x) -> Column:
    """Lower-case, collapse runs of non-alphanumerics to one space, trim."""
    return F.trim(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", " "))


def slug_regex(x) -> Column:
    """Lower-case, non-alphanumeric runs -> '-', strip dashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_c(x))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def dedupe_ids(arr) -> Column:
    """Trimmed, non-empty, order-preserving distinct."""
    return F.array_distinct(F.filter(F.transform(_c(arr), lambda s: F.trim(s)), lambda s: s != ""))


# ------------------------------------------------------------------ names, slugs, html
# Small words kept lower case inside display names.
TITLE_SMALL_WORDS = ("and", "or", "with", "the", "of", "in", "on", "to", "for")
# Acronyms kept upper case by the title rule.
KEEP_UPPER = ("trx", "jm", "ez", "smr", "tke")
# HTML entities decoded by the tag stripper (&amp; last, so decoding is one pass).
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
# Domain stop words of name tokens.
NAME_STOPWORDS = ("a", "an", "and", "bar", "body", "bodyweight", "cable", "dumbbell", "exercise", "freeweight",
                  "machine", "smith", "the", "with")
# Category and difficulty label maps.
CATEGORY_LABELS = (("strength", "Hypertrophy"), ("cardio", "Conditioning"), ("plyometrics", "Conditioning"),
                   ("stretching", "Mobility"), ("powerlifting", "Strength"))
DIFFICULTY_LABELS = (("beginner", "Beginner"), ("intermediate", "Intermediate"), ("expert", "Advanced"))
# Whitespace as Python's str.strip() understands it.
PY_SPACE = "\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"


#: The same characters one by one.
PY_SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                              0x205F, 0x3000]))


def py_strip(x) -> Column:
    return F.btrim(_c(x), F.lit(PY_SPACES))  # a regular expression would be tried at every character


def slug_replace(x) -> Column:
    """lower; '&' -> 'and'; '/', '_' -> space; one pass of double spaces; strip; spaces -> '-'."""
    s = F.replace(F.replace(F.replace(F.lower(_c(x)), F.lit("&"), F.lit("and")), F.lit("/"), F.lit(" ")), F.lit("_"), F.lit(" "))
    s = F.replace(s, F.lit("  "), F.lit(" "))
    return F.replace(py_strip(s), F.lit(" "), F.lit("-"))


def title_name(x) -> Column:
    """Title-case words split on '/' and whitespace, keeping listed acronyms upper case."""
    s = F.trim(F.regexp_replace(F.regexp_replace(_c(x), "[_\\-]+", " "), "\\s+", " "))
    parts = F.split(s, "(?<=[/ ])|(?=[/ ])")
    keep = F.array(*[F.lit(k) for k in KEEP_UPPER])
    cap = F.transform(parts, lambda p: F.when(F.array_contains(keep, F.lower(p)), F.upper(p))
                      .otherwise(F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 20)))))
    return F.trim(F.array_join(cap, ""))


def name_tokens(x, stopwords=NAME_STOPWORDS) -> Column:
    """Token *set* with the domain stop list, 1-character tokens dropped."""
    stop = F.array(*[F.lit(s) for s in stopwords])
    toks = F.regexp_extract_all(F.lower(_c(x)), F.lit("[a-z0-9]+"), 0)
    return F.array_distinct(F.filter(toks, lambda t: (F.length(t) > 1) & ~F.array_contains(stop, t)))


def strip_html(x) -> Column:
    """Tags -> newline, zero-width spaces dropped, listed entities decoded."""
    s = F.replace(F.regexp_replace(_c(x), "<[^>]+>", "\n"), F.lit("​"), F.lit(""))
    for ent, ch in HTML_ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return s


def clean_step(x) -> Column:
    """Drop a leading 'Step n' marker, zero-width space -> space, collapse whitespace, strip."""
    s = F.regexp_replace(py_strip(_c(x)), "(?i)^Step:?\\s*\\d+\\s*", "")
    s = F.replace(s, F.lit("​"), F.lit(" "))
    return py_strip(F.regexp_replace(s, f"[{PY_SPACE}]+", " "))


def label_map(x, pairs, default: Column) -> Column:
    v = F.lower(py_strip(_c(x)))
    out = default
    for k, lab in reversed(pairs):
        out = F.when(v == k, F.lit(lab)).otherwise(out)
    return out


def category_label(x) -> Column:
    v = F.lower(py_strip(_c(x)))
    return label_map(x, CATEGORY_LABELS, title_name(F.when(v == "", F.lit("Uncategorized")).otherwise(v)))


def difficulty_label(x) -> Column:
    return label_map(x, DIFFICULTY_LABELS, F.lit("Unverified"))


def rule_group(text, rules, default: str = "Unknown") -> Column:
    """First rule whose any needle is a substring of the lower-cased text; else ``default``."""
    t = F.lower(_c(text))
    out = F.lit(default)
    for needles, group in reversed(rules):
        cond = None
        for n in needles:
            c = F.instr(t, n) > 0
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(group)).otherwise(out)
    return out


def license_text(short, url, fallback) -> Column:
    s, u = F.trim(F.coalesce(_c(short), F.lit(""))), F.trim(F.coalesce(_c(url), F.lit("")))
    return (F.when((s != "") & (u != ""), F.concat(s, F.lit(" - "), u)).when(s != "", s)
             .otherwise(_c(fallback) if not isinstance(fallback, str) else F.lit(fallback)))


def first_text(*cols) -> Column:
    """First non-empty trimmed string among the candidates."""
    return F.coalesce(*[F.nullif(F.trim(_c(c)), F.lit("")) for c in cols], F.lit(""))


def has_youtube_id(url) -> Column:
    v = py_strip(F.coalesce(_c(url), F.lit("")))
    eleven = (F.length(v) == 11) & v.rlike("^[A-Za-z0-9_-]+$")
    marker = (F.instr(_c(url), "youtube.com/watch") > 0) | (F.instr(_c(url), "youtu.be/") > 0) | \
             (F.instr(_c(url), "youtube-nocookie.com/embed/") > 0)
    return eleven | F.coalesce(marker, F.lit(False))


def display_name(x) -> Column:
    """Title-case words (hyphen parts too) unless the text has an upper-case letter; small words
    after the first stay lower case."""
    v = _c(x)
    parts = F.split(v, "(?<=[\\s-])|(?=[\\s-])")

    def is_word(p):
        return (p != "") & ~p.rlike("^[\\s-]$")

    small = F.array(*[F.lit(w) for w in TITLE_SMALL_WORDS])

    def fmt(p, i):
        # word index = number of word parts before position i (0-based transform index)
        idx = F.aggregate(F.slice(F.concat(F.array(F.lit("-")), parts), 1, i + 1), F.lit(0),
                          lambda a, q: a + F.when(is_word(q), 1).otherwise(0))
        lw = F.lower(p)
        return (F.when(~is_word(p), p).when((idx > 0) & F.array_contains(small, lw), lw)
                 .otherwise(F.concat(F.upper(F.substring(lw, 1, 1)), F.substring(lw, 2, 1 << 20))))
    out = F.array_join(F.transform(parts, fmt), "")
    return F.when((v == "") | v.rlike("[A-Z]") | v.isNull(), v).otherwise(out)


def strip_chars(x, chars: str) -> Column:
    """Python ``str.strip(chars)``."""
    cls = "".join("\\" + ch if ch in "-]\\^" else ch for ch in chars).replace("\t", "\\t").replace("\n", "\\n")
    return F.regexp_replace(_c(x), f"^[{cls}]+|[{cls}]+$", "")


def instruction_steps(html) -> Column:
    """Numbered steps when there are at least two; otherwise lines, where a line that does not
    start with [A-Z0-9] continues the previous one."""
    t = F.replace(strip_html(html), F.lit("\r"), F.lit("\n"))
    t = py_strip(F.regexp_replace(t, "\n+", "\n"))
    t = F.regexp_replace(t, "(?i)Notes\\s*\\(Instructions?\\)\\s*:\\s*", "")
    num = F.filter(F.transform(F.split(t, "(?:^|\n)\\s*\\d+\\.\\s*"), lambda s: strip_chars(s, " -\t\n")),
                   lambda s: s != "")
    lines = F.filter(F.transform(F.split(t, "\n"), lambda s: strip_chars(s, " -\t")), lambda s: s != "")
    empty = F.array().cast("array<string>")

    def step(acc, line):
        n = F.size(acc)
        cont = (n > 0) & ~line.rlike("^[A-Z0-9]")
        # acc[1..n-1] + [strip(acc[n] + " " + line)]; the padded copy keeps slice/element_at in range.
        padded = F.concat(acc, F.array(F.lit("")))
        merged = F.concat(F.slice(padded, 1, F.greatest(n - 1, F.lit(0))),
                          F.array(py_strip(F.concat(F.element_at(padded, F.greatest(n, F.lit(1))), F.lit(" "), line))))
        return F.when(cont, merged).otherwise(F.concat(acc, F.array(line)))
    merged_lines = F.aggregate(lines, empty, step)
    return F.when(F.size(num) >= 2, num).otherwise(merged_lines)


def modifier_tags(myo, myo_match, uni, drop, partials) -> Column:
    tags = F.array(F.when(myo, F.when(myo_match, F.lit("Myo match")).otherwise(F.lit("Myo"))),
                   F.when(uni, F.lit("Uni")), F.when(drop, F.lit("Drop")), F.when(partials, F.lit("Partials")))
    return F.filter(tags, lambda x: x.isNotNull())


def duration(seconds) -> Column:
    """``1h 05m`` from an hour on, else ``m:ss``."""
    s = _c(seconds).cast("long")
    h, m, sec = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %02dm", h, m)).otherwise(F.format_string("%d:%02d", m, sec))


def rep_range_center(center) -> tuple[Column, Column]:
    c = _c(center)
    return F.greatest(F.lit(5), c - 1), F.least(F.lit(15), c + 1)
