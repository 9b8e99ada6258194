"""Text cleaning over a documents table. Every operator reports before and after sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.functions.patterns import slow_on_some_text
from rowsmith.operators import ordered
from rowsmith.operators.rules import apply_rules
from rowsmith.session import materialise


def with_sizes(docs: DataFrame, cleaned: Column, text: str = "text") -> DataFrame:
    """Replace ``text`` by ``cleaned`` and add chars_before, chars_after, chars_saved."""
    before = F.length(T.unify_newlines(text)).cast("long")
    out = docs.withColumn("_cleaned", cleaned).withColumn("chars_before", before)
    out = out.withColumn("chars_after", F.length("_cleaned").cast("long"))
    return (
        out.withColumn("chars_saved", F.col("chars_before") - F.col("chars_after"))
        .withColumn(text, F.col("_cleaned")).drop("_cleaned")
    )


def normalise_ws(docs: DataFrame, **options: bool) -> DataFrame:
    return with_sizes(docs, T.normalise_whitespace("text", **options))


def unwrap(docs: DataFrame, **options) -> DataFrame:
    docs = docs.withColumn("lines_before", F.size(T.split_lines("text")).cast("long"))
    out = with_sizes(docs, T.unwrap_lines("text", **options))
    return out.withColumn("lines_after", F.size(T.split_lines("text")).cast("long"))


def collapse_blank(docs: DataFrame) -> DataFrame:
    return with_sizes(docs, T.collapse_blank_runs(T.unify_newlines("text")))


def find_replace(
    docs: DataFrame, needle: str, repl: str, regex: bool = False, case: bool = False, word: bool = False
) -> DataFrame:
    """Replaced text, the number of hits, and a finding: a pattern that is bad or could hang changes no text and says
    why. An empty needle changes nothing."""
    none = F.lit(None).cast("string")
    problem = pattern_problem(docs.sparkSession, needle) if regex else None
    if needle == "" or problem:
        return docs.withColumn("hits", F.lit(0).cast("long")).withColumn("finding", F.lit(problem) if problem else none)
    pattern = T.search_pattern(needle, regex, case, word)
    replacement = repl if regex else T.literal_replacement(repl)
    return docs.withColumn("hits", F.regexp_count("text", F.lit(pattern)).cast("long")).withColumn(
        "text", F.regexp_replace("text", pattern, replacement)
    ).withColumn("finding", none)


def _alternatives_overlap(body: str) -> bool:
    """Whether two alternatives of a group may begin alike: the same first character, or one that is no plain character."""
    depth, parts, at = 0, [""], 0
    while at < len(body):
        step = 2 if body[at] == "\\" else 1
        piece = body[at : at + step]
        depth += (piece in "([") - (piece in ")]") if step == 1 else 0
        if piece == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += piece
        at += step
    firsts = [p[:1] for p in parts]
    plain = all(f.isalnum() or f in " _-,;:" for f in firsts)
    return len(parts) > 1 and (not plain or len(set(firsts)) < len(firsts))


ALIKE = "a repeated group holds alternatives that can begin alike"


def repeats_without_end(pattern: str) -> str | None:
    """What in the shape of a pattern stands for repetition in repetition: a repeated group that holds a repetition, or
    alternatives that can begin alike, at any depth."""
    opened, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 2
            continue
        if c == "[":
            end = pattern.find("]", at + 2)
            at = end if end > 0 else len(pattern)
        elif c == "(":
            opened.append([at + 1, False, False])
        elif c == ")" and opened:
            start, repeats, overlaps = opened.pop()
            body = re.sub(r"^\?(:|<\w+>|[imsux-]+:)", "", pattern[start:at])
            overlaps = overlaps or _alternatives_overlap(body)
            if re.match(r"[*+]|\{\d+,\d*\}", pattern[at + 1 :]):
                if repeats:
                    return "a repeated group holds a repetition"
                if overlaps:
                    return ALIKE
                repeats = True
            if opened:
                opened[-1][1] |= repeats
                opened[-1][2] |= overlaps
        elif opened and re.match(r"[*+]|\{\d+,\d*\}", pattern[at:]):
            opened[-1][1] = True
        at += 1
    return None


def pattern_problem(spark, pattern: str) -> str | None:
    """None for a pattern the engine accepts and can run safely, else what is wrong."""
    slow = slow_on_some_text(pattern)
    if slow == "exponential":
        # The shape of the pattern says it more plainly, where it does.
        return repeats_without_end(pattern) or "one text can be matched in exponentially many ways"
    if slow:
        return "more than two repetitions behind one another can take the same text"
    # No loss of time by itself, but each such choice is remembered by the engine, as deep as the text is long.
    if (shape := repeats_without_end(pattern)) == ALIKE:
        return shape
    try:
        spark.range(1).select(F.lit("").rlike(pattern)).first()
    except Exception as error:
        return str(error).splitlines()[0]
    return None


def group_names(pattern: str) -> list[str | None]:
    """The name of every capturing group in order, None where it has none."""
    found = re.finditer(r"\\.|\[(?:\\.|[^\]])*\]|\(\?<([A-Za-z]\w*)>|(\()(?!\?)", pattern)
    return [m.group(1) for m in found if m.group(1) or m.group(2)]


def regex_matches(docs: DataFrame, pattern: str, groups: int | None = None, limit: int | None = None, flags: str = "") -> DataFrame:
    """Every match with its number, start, text and groups; empty matches included.

    The text is cut at its matches: what lies before a match and the matches before it give its start, inside the row.
    ``flags`` are letters of i, m, s and x. A named group's column has its name. A pattern that is bad or could hang is
    refused before any job runs.
    """
    if problem := pattern_problem(docs.sparkSession, pattern):
        raise ValueError(problem)
    names = group_names(pattern)
    names = names if groups is None else (names + [None] * groups)[:groups]
    pattern = f"(?{flags}){pattern}" if flags else pattern
    labels = [name or f"group_{i + 1}" for i, name in enumerate(names)]
    parts = [F.regexp_extract_all("text", F.lit(pattern), F.lit(g)).alias(f"_g{g}") for g in range(len(names) + 1)]
    # A text without a match has no rows; a filter for it would search every text twice.
    found = docs.select("doc_id", F.split("text", pattern, -1).alias("_cut"), *parts)
    # Cutting leaves out the empty piece before an empty match at the very start.
    gaps = F.when(F.size("_cut") == F.size("_g0"), F.concat(F.array(F.lit("")), F.col("_cut"))).otherwise(F.col("_cut"))
    steps = F.zip_with(F.slice(gaps, 1, F.size("_g0")), F.col("_g0"), lambda gap, match: (F.length(gap) + F.length(match)).cast("long"))
    zipped = F.arrays_zip(T.running_sums(steps).alias("stop"), *[F.col(f"_g{g}") for g in range(len(names) + 1)])
    rows = found.select("doc_id", F.posexplode(zipped).alias("_no", "_z"))
    start = F.col("_z.stop") - F.length("_z._g0")
    out = rows.select(
        "doc_id", F.col("_no").cast("long").alias("match_no"), start.alias("start"), F.col("_z._g0").alias("match"),
        *[F.col(f"_z._g{g + 1}").alias(label) for g, label in enumerate(labels)],
    )
    return out if limit is None else out.where(F.col("match_no") < limit)


def case_variants(df: DataFrame, column: str, style: str = "snake") -> DataFrame:
    """Group naming variants of one thing: rows and distinct spellings per key."""
    spelled = df.groupBy(T.recase(column, style).alias("case_key"), column).agg(F.count(F.lit(1)).alias("_n"))
    return spelled.groupBy("case_key").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("spellings"))


def assign_slugs(df: DataFrame, title: str, key: str, bounded: bool = False) -> DataFrame:
    """A URL slug per row, no two alike: the first row with a slug keeps it, the others take -2, -3 and so on in the order
    of ``key``, leaving out the numbers that make another title's own slug ("a", "a", "a 2": a, a-3, a-2).

    A slug with a number splits into slug and number in one way only, so numbered slugs clash with own slugs alone, and
    the free numbers of a slug follow from the taken ones without trying: the j-th free number is j + 1 and the count of
    taken numbers before it. That count is a running sum over both, so a slug of any number of rows or takers is spread.
    """
    slugged = df.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.coalesce(F.nullif(T.slug(title), F.lit("")), F.lit("untitled")).alias("_slug"))
    placed = materialise(ordered.scan(slugged, ["_slug"], [F.col("_key")], position="_copy", bounded=bounded), "slugs")
    own, again = placed.where("_copy = 1").select("_slug"), placed.where("_copy > 1")
    ending = F.regexp_extract("_slug", r"\A(.+)-([1-9][0-9]{0,17})\z", 2)
    taken = own.where(ending != "").select(F.regexp_extract("_slug", r"\A(.+)-[1-9][0-9]{0,17}\z", 1).alias("_slug"), ending.cast("long").alias("_n"))
    taken = taken.where("_n > 1").join(placed.where("_copy = 2").select("_slug"), "_slug", "left_semi")
    numbered = F.concat("_slug", F.when(F.col("_copy") > 1, F.concat(F.lit("-"), F.col("_copy").cast("string"))).otherwise("")).alias("slug")
    if taken.isEmpty():
        return placed.select("_row.*", numbered)
    taken = materialise(ordered.scan(taken, ["_slug"], [F.col("_n")], position="_i", bounded=bounded), "taken")
    # A taken number n, the i-th of its slug, comes before the j-th free one if n - i + 1 is j + 1 at most.
    marks = taken.select("_slug", (F.col("_n") - F.col("_i") + 1).alias("_at"), F.lit(1).alias("_taken"), F.lit(None).cast(placed.schema["_row"].dataType).alias("_row"))
    asked = again.join(taken.select("_slug").distinct(), "_slug", "left_semi")
    both = marks.unionByName(asked.select("_slug", F.col("_copy").alias("_at"), F.lit(0).alias("_taken"), "_row"))
    counted = ordered.scan(both, ["_slug"], [F.col("_at"), F.col("_taken").desc(), F.xxhash64("_row")], running={"_before": "_taken"}, bounded=bounded)
    shifted = counted.where("_taken = 0").select("_row", "_slug", (F.col("_at") + F.col("_before")).alias("_copy"))
    plain = placed.where("_copy = 1").unionByName(again.join(taken.select("_slug").distinct(), "_slug", "left_anti"))
    return plain.select("_row", "_slug", "_copy").unionByName(shifted).select("_row.*", numbered)


# Digest names and whether a name is too weak to trust.
DIGESTS = {"SHA-1": True, "SHA-256": False, "SHA-384": False, "SHA-512": False}


def digest(content: Column, algo: str = "SHA-256", upper: bool = False) -> Column:
    if algo not in DIGESTS:
        raise ValueError(f"unknown digest {algo!r}")
    out = F.sha1(content) if algo == "SHA-1" else F.sha2(content, int(algo.split("-")[1]))
    return F.upper(out) if upper else out


def content_hash(df: DataFrame, column: str = "text", algo: str = "SHA-256", upper: bool = False) -> DataFrame:
    return df.withColumn("digest", digest(F.col(column), algo, upper)).withColumn("weak", F.lit(DIGESTS[algo]))


def duplicate_groups(df: DataFrame, key: str, column: str = "text", algo: str = "SHA-256") -> DataFrame:
    """Digests held by more than one row: how many and the first key. Only digests are shuffled."""
    hashed = df.select(key, digest(F.col(column), algo).alias("digest"))
    return hashed.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_key")).where("copies > 1")


def verify_manifest(files: DataFrame, manifest: DataFrame, name: str = "name") -> DataFrame:
    """ok, changed, missing (listed, not found) or unlisted, per file."""
    found, listed = files.select(name, F.col("digest").alias("_found")), manifest.select(name, F.col("digest").alias("_listed"))
    state = (
        F.when(F.col("_listed").isNull(), "unlisted")
        .when(F.col("_found").isNull(), "missing")
        .when(F.lower("_found") == F.lower("_listed"), "ok")
        .otherwise("changed")
    )
    return found.join(listed, name, "full_outer").select(name, state.alias("state"))


def literal_count(text: Column, find: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(find), F.lit("")))) / len(find)).cast("long")


def longest_first(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longer phrases first, so a name inside an address is not rewritten before the address."""
    return sorted((r for r in rules if r[0]), key=lambda r: -len(r[0]))


def bulk_rewrite(docs: DataFrame, rules: list[tuple[str, str]] | DataFrame, text: str = "text") -> DataFrame:
    """Literal replacements, longest first; adds ``edits`` and ``changed``.

    A handful of rules is applied one after another, one projection each, all in one stage. A table of rules
    (find, replace_by) of any length is applied in one pass, see ``rules.apply_rules``.
    """
    if isinstance(rules, DataFrame):
        return apply_rules(docs, rules, text)
    out = docs.withColumn("_old", F.col(text)).withColumn("edits", F.lit(0).cast("long"))
    for find, repl in longest_first(rules):
        out = out.withColumn("edits", F.col("edits") + literal_count(F.col(text), find)).withColumn(
            text, F.replace(F.col(text), F.lit(find), F.lit(repl))
        )
    return out.withColumn("changed", F.col(text) != F.col("_old")).drop("_old")
