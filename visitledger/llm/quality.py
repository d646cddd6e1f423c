"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds what was measured and one bit for each rule that failed;
a policy is a versioned set of rules, so a verdict is one bitwise AND and an ablation is an aggregation over the few
bit patterns that occur. Only built-in functions, no shuffle: a document never meets another one.

Defined results: a null or empty text has no words (all measures 0) and fails ``few_words``; documents may repeat in any
way, each row is judged by itself; an empty table gives an empty ledger; a null id stays null. Long texts are one row's
array of words, about eight bytes a word beside the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import SPACE, SPACE_CLASS, free_name, named

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measures; the rule's place in the list is its bit."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...]) -> int:
        known = {r.name: i for i, r in enumerate(rules)}
        return sum(1 << known[r] for r in self.rules)


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 20 * word_chars"),
    Rule("duplicate_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 60 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)
BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = (
    BASE,
    Policy("web", 1, (*BASE.rules, "symbols")),
    Policy("web", 2, (*BASE.rules, "symbols", "duplicate_lines", "word_length")),
)
CURRENT = POLICIES[-1]


def _measured(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the measures as fields of the struct ``out``; intermediate arrays are dropped again."""
    kept = docs.columns
    n = {k: free_name([*kept, out], f"{out}_{k}") for k in ("text", "words", "bits", "lines", "grams", "twice")}
    q = {k: "`" + v.replace("`", "``") + "`" for k, v in n.items()}
    whole = F.coalesce(named(text).cast("string"), F.lit(""))
    step = docs.withColumn(n["text"], whole)
    trimmed = F.btrim(named(n["text"]), F.lit(SPACE))
    step = step.withColumns({
        n["words"]: F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
            F.split(trimmed, SPACE_CLASS + "+")),
        n["lines"]: F.filter(F.split(named(n["text"]), "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
    })
    # a window is its hash above its position in one long, so equal windows are neighbours after a primitive sort
    step = step.withColumn(n["bits"], F.length(F.bin(F.size(named(n["words"])))))
    window = f"shiftleft(xxhash64({q['words']}[i], {q['words']}[i + 1], {q['words']}[i + 2]), {q['bits']}) | i"
    step = step.withColumn(n["grams"], F.expr(
        f"IF(size({q['words']}) < 3, CAST(array() AS array<bigint>), "
        f"sort_array(transform(sequence(0L, size({q['words']}) - 3L), i -> {window})))"))
    same = (f"(k > 0 AND shiftrightunsigned(x, {q['bits']}) = shiftrightunsigned({q['grams']}[k - 1], {q['bits']})) OR "
            f"(k < size({q['grams']}) - 1 AND "
            f"shiftrightunsigned(x, {q['bits']}) = shiftrightunsigned({q['grams']}[k + 1], {q['bits']}))")
    step = step.withColumn(n["twice"], F.expr(
        f"transform(filter({q['grams']}, (x, k) -> {same}), x -> x & (shiftleft(1L, {q['bits']}) - 1L))"))
    covered = F.array_union(
        F.array_union(named(n["twice"]), F.transform(named(n["twice"]), lambda x: x + 1)),
        F.transform(named(n["twice"]), lambda x: x + 2))
    letters = F.translate(named(n["text"]), SPACE, "")
    values = {
        "n_words": F.size(named(n["words"])),
        "word_chars": F.length(letters),
        "n_symbols": F.length(named(n["text"])) - F.length(F.translate(named(n["text"]), SYMBOLS, "")),
        "n_lines": F.size(named(n["lines"])),
        "n_dup_lines": F.size(named(n["lines"])) - F.size(F.array_distinct(named(n["lines"]))),
        "n_repeat_words": F.size(covered),
    }
    fields = F.struct(*[v.cast("long").alias(k) for k, v in values.items()])
    return step.select(*[named(c) for c in kept], fields.alias(out))


def with_ledger(docs: DataFrame, text: str, out: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` and a struct column ``out`` of the measures and ``failures`` (bit i: rule i failed)."""
    step = _measured(docs, text, out)
    inner = free_name(docs.columns, f"{out}_m")
    measured = step.withColumnRenamed(out, inner)
    fields = {m: f"`{inner}`.{m}" for m in MEASURES}

    def bit(i: int, rule: Rule) -> Column:
        sql = rule.fails
        for m in sorted(MEASURES, key=len, reverse=True):
            sql = sql.replace(m, f"@{MEASURES.index(m)}@")
        for i_m, m in enumerate(MEASURES):
            sql = sql.replace(f"@{i_m}@", fields[m])
        return F.expr(f"IF({sql}, {1 << i}L, 0L)")

    failures = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        failures = failures.bitwiseOR(bit(i, rule))
    struct = F.struct(*[F.expr(v).alias(m) for m, v in fields.items()], failures.alias("failures"))
    # a filter on the verdict must not be pushed down: it would evaluate the measures anew for every place that names them
    return measured.select(*[named(c) for c in docs.columns], F.explode(F.array(struct)).alias(out))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: key, measures, failures. Other columns of ``docs`` are not read."""
    out = free_name([key, text], "ledger")
    step = with_ledger(docs.select(named(key), named(text)), text, out, rules)
    return step.select(named(key), *[F.col(f"`{out}`.{m}") for m in (*MEASURES, "failures")])


def passes(failures: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return failures.bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def accepted(docs: DataFrame, text: str = "text", policy: Policy = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns."""
    out = free_name(docs.columns, "ledger")
    step = with_ledger(docs, text, out, rules)
    return step.filter(passes(F.col(f"`{out}`.failures"), policy, rules)).select(*[named(c) for c in docs.columns])


def ablations(ledgers: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each policy loses or gains by each of its rules.

    policy, version, rule, documents, kept, failed_rule (documents that fail the rule), only_rule (documents that
    nothing else of the policy rejects), kept_without. The ledger is reduced to its bit patterns first, at most two to
    the power of the number of rules; everything else is bitwise work on those. An empty ledger gives no rows.
    """
    patterns = ledgers.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    index = {r.name: i for i, r in enumerate(rules)}
    cases = F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                 F.lit(p.mask(rules)).cast("long").alias("mask"), F.lit(1 << index[r]).cast("long").alias("bit"))
        for p in policies for r in p.rules])
    seen = patterns.withColumn("case", F.explode(cases)).select("failures", "n", "case.*")
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    failed = F.col("failures").bitwiseAND(F.col("bit")) != 0
    amount = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    return seen.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("documents"), amount(hit == 0).alias("kept"), amount(failed).alias("failed_rule"),
        amount(hit == F.col("bit")).alias("only_rule"),
        amount((hit == 0) | (hit == F.col("bit"))).alias("kept_without"))


def fired(ledgers: DataFrame, *by: str) -> DataFrame:
    """For each group the rules that some document failed (``any_failed``) and that all failed (``all_failed``)."""
    return ledgers.groupBy(*by).agg(F.bit_or("failures").alias("any_failed"), F.bit_and("failures").alias("all_failed"),
                                    F.count(F.lit(1)).alias("documents"))
