"""Quality rules for whole texts: a table of thresholds compiled into column expressions.

``measures`` turns a text into counts (words, characters, symbols, capitals, lines, stop words, repeats). ``RULES`` holds
one row per rule: a measure, what it is counted against, and the bounds of the ratio in percent. ``verdict`` compiles the
table into one boolean column, so that changing a threshold changes the plan and nothing else; ``failures`` names the
rules a text breaks. Only column functions are used; texts never leave the row, so nothing is shuffled.

A word is a run of characters other than the six ASCII white-space characters. Windows of five words are compared by
64-bit hashes: texts whose windows are all distinct stop there; the others sort their windows with their places, so the
work grows with n log n for a text of n words.

Defined results: null and empty texts have counts of zero, fail the base rules and are dropped; ratios against zero are
never formed (rules compare products); a text of fewer than five words has no window; repeated rows and equal or null
ids are judged each for itself; an empty table gives an empty result; other columns are kept beside the measures, and
a column of a measure's name is replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 5

# Frequent words of English, German, French and Spanish.
STOP_WORDS = [
    "a", "al", "and", "as", "at", "auf", "be", "by", "con", "dans", "das", "de", "del", "den", "der", "des", "die", "du",
    "ein", "eine", "el", "en", "es", "est", "et", "for", "from", "für", "im", "in", "is", "ist", "it", "la", "las", "le", "les",
    "los", "mit", "nicht", "of", "on", "or", "par", "para", "por", "pour", "que", "qui", "se", "sich", "su", "sur", "than",
    "that", "the", "this", "to", "un", "una", "und", "une", "von", "was", "with", "y", "zu",
]


class Rule(NamedTuple):
    """``least`` <= 100 * measure / per <= ``most``, in percent; None leaves a side open."""

    name: str
    measure: str
    per: str
    least: int | None
    most: int | None


#: Judged first; the result calls them ``base_failed``.
BASE = [
    Rule("too_few_words", "n_words", "one", 1000, None),
    Rule("repeated_windows", "n_repeat_words", "n_words", None, 20),
]
RULES = [
    Rule("word_length", "word_chars", "n_words", 250, 1200),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("exclamations", "n_exclamations", "n_words", None, 20),
    Rule("capitals", "n_capitals", "word_chars", None, 30),
    Rule("stop_words", "n_stop_words", "n_words", 4, None),
    Rule("doubled_words", "n_doubled_words", "n_words", None, 20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("cut_lines", "n_cut_lines", "n_lines", None, 50),
]


def stop_forms(words: list[str] = STOP_WORDS) -> list[str]:
    """Each word as it stands, at the start of a sentence and in capitals."""
    return sorted({form for w in words for form in (w, w.capitalize(), w.upper())})


def repeated(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, for an array of window hashes."""
    places = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))

    def twice(p: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(p, lambda x, i: (x["hash"] == F.get(p, i - 1)["hash"]) | (x["hash"] == F.get(p, i + 1)["hash"])),
            lambda x: x["place"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), 0)

    return (F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0))
            .otherwise(let(let(places, twice), covered)))


def measures(docs: DataFrame, text: str = "text", stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with the counts of each text, all long."""
    forms = stop_forms(stop_words)
    body = F.coalesce(F.col(text), F.lit(""))
    out = (docs.withColumn("__text", body)
           .withColumn("__words", F.filter(F.split("__text", "[ \\t-\\r]+"), lambda w: w != ""))
           .withColumn("__lines", F.filter(F.split("__text", "\n"), lambda l: F.translate(l, " \t\u000b\f\r", "") != ""))
           .withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w))))
    h = F.col("__hashes")
    windows = F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("__windows", windows)
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.char_length(F.array_join("__words", "")),
        "n_symbols": F.regexp_count("__text", F.lit("[#*$%&|<>]")),
        "n_exclamations": F.char_length("__text") - F.char_length(F.replace("__text", F.lit("!"))),
        "n_capitals": F.regexp_count("__text", F.lit("\\p{Lu}")),
        "n_stop_words": F.size(F.filter("__words", lambda w: w.isin(*forms))),
        "n_doubled_words": F.size(F.filter("__hashes", lambda x, i: x == F.get(h, i - 1))),
        "n_repeat_words": repeated(F.col("__windows")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_cut_lines": F.size(F.filter("__lines", lambda l: l.endswith("...") | l.endswith("…"))),
    }
    # A row generator, since filters on the counts would otherwise be pushed below them and count everything again.
    row = F.array(F.struct(*[value.cast("long").alias(name) for name, value in counts.items()]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in counts], F.inline(row))


def holds(rule: Rule) -> Column:
    measure, per = F.col(rule.measure), F.lit(1) if rule.per == "one" else F.col(rule.per)
    bounds = ([] if rule.least is None else [100 * measure >= rule.least * per]) + (
        [] if rule.most is None else [100 * measure <= rule.most * per])
    both = bounds[0]
    for bound in bounds[1:]:
        both = both & bound
    return both


def verdict(rules: list[Rule]) -> Column:
    """True where every rule holds."""
    out = F.lit(True)
    for rule in rules:
        out = out & holds(rule)
    return out


def failures(rules: list[Rule]) -> Column:
    """Names of the rules that do not hold, in the order of the table."""
    return F.filter(F.array(*[F.when(~holds(r), F.lit(r.name)) for r in rules]), lambda name: name.isNotNull())


def judge(docs: DataFrame, text: str = "text", base: list[Rule] = BASE, rules: list[Rule] = RULES,
          stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``kept`` and ``failed`` (names of all rules broken)."""
    out = measures(docs, text, stop_words).withColumn("base_failed", ~verdict(base))
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules)).withColumn("failed", failures([*base, *rules]))


def measures_sql(table: str = "documents", stop_words: list[str] = STOP_WORDS) -> str:
    """The measures as SQL for DuckDB, for checks."""
    stops = ", ".join("'" + f.replace("'", "''") + "'" for f in stop_forms(stop_words))
    return rf"""
with given as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as text from {table}
), split as (
    select rid, doc_id, text,
        list_filter(string_split_regex(text, '[ \t-\r]+'), lambda w: w <> '') as words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) as lines
    from given
), word as (
    select rid, unnest(words) as w, generate_subscripts(words, 1) as place from split
), windowed as (
    select rid, place, lag(w) over doc as before,
        case when lead(w, 4) over doc is not null then concat_ws(' ', w, lead(w, 1) over doc, lead(w, 2) over doc,
            lead(w, 3) over doc, lead(w, 4) over doc) end as gram, w
    from word window doc as (partition by rid order by place)
), counted as (
    select *, case when gram is not null then count(*) over (partition by rid, gram) end as times from windowed
), covered as (
    select rid, w, before, max(case when times >= 2 then 1 else 0 end)
        over (partition by rid order by place rows between 4 preceding and current row) as hit
    from counted
), per_doc as (
    select rid, sum(hit) as n_repeat_words, count(*) filter (w in ({stops})) as n_stop_words,
        count(*) filter (w = before) as n_doubled_words
    from covered group by rid
)
select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g'))::bigint as n_exclamations,
    length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g'))::bigint as n_capitals,
    coalesce(n_stop_words, 0)::bigint as n_stop_words, coalesce(n_doubled_words, 0)::bigint as n_doubled_words,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    len(list_filter(lines, lambda l: l.ends_with('...') or l.ends_with('…')))::bigint as n_cut_lines
from split left join per_doc using (rid)
"""


def holds_sql(rule: Rule) -> str:
    per = "1" if rule.per == "one" else rule.per
    bounds = ([] if rule.least is None else [f"100 * {rule.measure} >= {rule.least} * {per}"]) + (
        [] if rule.most is None else [f"100 * {rule.measure} <= {rule.most} * {per}"])
    return " and ".join(bounds)


def judged_sql(columns: str, table: str = "documents") -> str:
    """``judge`` as SQL for DuckDB."""
    base, rules = (" and ".join(holds_sql(r) for r in table_) for table_ in (BASE, RULES))
    return f"select {columns}, not ({base}) as base_failed, ({base} and {rules}) as kept from ({measures_sql(table)})"
