"""Data-quality rules as data.

A rule set is a plain dict (see ``fixed_values.DEFAULT_RULES`` for its shape).  ``RuleSet`` turns
it into Column expressions; nothing in it looks at rows on its own."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.functions.text import any_of, as_col, missing, outside


def load_rules(path: str) -> dict:
    """Read a rule file, JSON or (where a YAML reader is installed) YAML, on the driver."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as gone:
            raise RuntimeError("reading YAML rules needs the yaml module; JSON always works") from gone
        return yaml.safe_load(handle)


class RuleSet:
    """Compiles a rule dict to expressions.

    A rule that names a column the frame lacks is FALSE, a disabled rule is FALSE, a code missing
    from the priority list is never assigned and an unknown code in it never matches."""

    def __init__(self, config: Mapping[str, Any] | None = None):
        self.config = config if isinstance(config, Mapping) else {}
        rules = self.config.get("rules", {})
        self.rules: Mapping[str, Any] = rules if isinstance(rules, Mapping) else {}
        priority = self.config.get("dq_flag_priority")
        usable = isinstance(priority, (list, tuple)) and len(priority) > 0
        self.priority: list[str] = list(priority) if usable else list(fv.FLAG_PRIORITY)

    @classmethod
    def default(cls) -> RuleSet:
        return cls(fv.DEFAULT_RULES)

    def changed(self, **by_code: Mapping[str, Any]) -> RuleSet:
        """The same rules with some settings replaced, e.g. ``changed(DATE_FORMAT={"strict": True})``."""
        rules = {code: {**self.setting(code), **by_code.get(code, {})} for code in {*self.rules, *by_code}}
        return RuleSet({**self.config, "rules": rules})

    def setting(self, code: str) -> Mapping[str, Any]:
        found = self.rules.get(code, {})
        return found if isinstance(found, Mapping) else {}

    def enabled(self, code: str) -> bool:
        return bool(self.setting(code).get("enabled", True))

    def action(self, code: str) -> str:
        return self.setting(code).get("handling_action", "FLAGGED")

    def excludes(self, code: str) -> bool:
        return self.action(code) in fv.EXCLUDING_ACTIONS

    @property
    def keeps_orphans(self) -> bool:
        """Whether transactions of unknown accounts become facts, of an unknown member."""
        return self.enabled(fv.ORPHANED_ACCOUNT) and not self.excludes(fv.ORPHANED_ACCOUNT)

    def broken_date(self, raw: str, parsed: str, columns: Collection[str]) -> Column:
        """The date rule for a date of another source."""
        other = self.changed(**{fv.DATE_FORMAT: {"source_field": raw, "parsed_field": parsed}})
        return F.coalesce(other.predicate(fv.DATE_FORMAT, columns), F.lit(False))

    @property
    def keep(self) -> str:
        """Which delivery of a transaction stays, by the action of the duplicate rule."""
        return "latest" if self.action(fv.DUPLICATE_DEDUPED) in fv.KEEP_LATEST_ACTIONS else "earliest"

    def tests_key(self) -> str:
        """The same for rule sets that differ in handling actions alone, but keep the same delivery."""
        tests = {code: {k: v for k, v in self.setting(code).items() if k != "handling_action"} for code in self.rules}
        return json.dumps([tests, self.keep], sort_keys=True, default=repr)

    # -- predicates --------------------------------------------------------------------------

    def predicate(self, code: str, columns: Collection[str]) -> Column:
        """When a row breaks the rule.  May be NULL, which counts as "no"."""
        build = {
            fv.NULL_REQUIRED: self._null_required,
            fv.TYPE_MISMATCH: self._type_mismatch,
            fv.DATE_FORMAT: self._date_format,
            fv.CURRENCY_VARIANT: self._currency_variant,
            fv.ORPHANED_ACCOUNT: self._orphaned_account,
            fv.DUPLICATE_DEDUPED: self._duplicate,
        }.get(code)
        if build is None or not self.enabled(code):
            return F.lit(False)
        # What a rule file leaves out comes from the default rules; only domains it leaves out are open.
        default = {k: v for k, v in fv.DEFAULT_RULES["rules"].get(code, {}).items() if not k.startswith("allowed_")}
        return build({**default, **self.setting(code)}, columns)

    @staticmethod
    def _unreadable(raw: str, parsed: str, columns: Collection[str]) -> list[Column]:
        """Delivered, but not what it should be."""
        return [F.col(raw).isNotNull() & F.col(parsed).isNull()] if {raw, parsed} <= set(columns) else []

    def _null_required(self, rule: Mapping, columns: Collection[str]) -> Column:
        return any_of(missing(c) for c in rule["fields"] if c in columns)

    def _type_mismatch(self, rule: Mapping, columns: Collection[str]) -> Column:
        tests = self._unreadable(rule["amount_raw_field"], rule["amount_cast_field"], columns)
        as_text = rule.get("amount_is_text_field", "amount_is_text")
        if rule.get("strict") and as_text in columns:
            tests.append(F.col(as_text))
        stamp, parts = rule["timestamp_field"], [c for c in rule["timestamp_source_fields"] if c in columns]
        if stamp in columns and parts:
            tests.append(~any_of(F.col(c).isNull() for c in parts) & F.col(stamp).isNull())
        domains = {"transaction_type": rule.get("allowed_transaction_types", []), "channel": rule.get("allowed_channels", [])}
        tests += [outside(name, list(allowed)) for name, allowed in domains.items() if name in columns]
        return any_of(tests)

    def _date_format(self, rule: Mapping, columns: Collection[str]) -> Column:
        raw = rule["source_field"]
        if rule.get("strict"):
            return any_of([F.col(raw).isNotNull() & ~F.col(raw).rlike(fv.ISO_DATE_REGEX)] if raw in columns else [])
        return any_of(self._unreadable(raw, rule["parsed_field"], columns))

    def _currency_variant(self, rule: Mapping, columns: Collection[str]) -> Column:
        raw, target = rule["source_field"], str(rule["target_value"])
        value = as_col(raw).cast("string")
        shown, wanted = (value, target) if rule.get("strict") else (F.upper(value), target.upper())
        return any_of([value.isNotNull() & (shown != F.lit(wanted))] if raw in columns else [])

    def _orphaned_account(self, rule: Mapping, columns: Collection[str]) -> Column:
        mark = rule["reference_present_field"]
        return any_of([F.col(mark).isNull()] if mark in columns else [])

    def _duplicate(self, rule: Mapping, columns: Collection[str]) -> Column:
        size = rule["duplicate_count_field"]
        return any_of([F.col(size) > 1] if size in columns else [])

    # -- rows --------------------------------------------------------------------------------

    def flag(self, columns: Collection[str]) -> Column:
        """The first broken rule in priority order, NULL for a clean row."""
        return first_match([(c, self.predicate(c, columns)) for c in self.priority])

    def issues(self, columns: Collection[str]) -> Column:
        """Every broken rule, in priority order."""
        return all_matches([(c, self.predicate(c, columns)) for c in self.priority])

    def exclusion(self, columns: Collection[str]) -> Column:
        """The first broken rule whose handling keeps the row out of the output, else NULL."""
        return first_match([(c, self.predicate(c, columns)) for c in self.priority if self.excludes(c)])

    # -- rules that only need the row itself, kept as one integer through a shuffle -----------

    def row_rules(self, columns: Collection[str]) -> list[str]:
        late = {fv.ORPHANED_ACCOUNT, fv.DUPLICATE_DEDUPED}
        return [c for c in fv.FLAG_PRIORITY if c not in late]

    def row_bits(self, columns: Collection[str]) -> Column:
        """The broken row rules as bits, so the raw text need not travel any further."""
        bits = F.lit(0)
        for place, code in enumerate(self.row_rules(columns)):
            bits = bits + F.when(self.predicate(code, columns), F.lit(1 << place)).otherwise(F.lit(0))
        return bits

    def broken_totals(self, bits: str, columns: Collection[str]) -> dict[str, Column]:
        """For each row rule how many rows of a group break it, as aggregates by column name."""
        return {f"_n_{c}": F.sum(F.shiftright(bits, i).bitwiseAND(1).cast("bigint")) for i, c in enumerate(self.row_rules(columns))}

    def predicates_from_bits(self, bits: str, columns: Collection[str]) -> dict[str, Column]:
        known = {c: F.col(bits).bitwiseAND(1 << i) != 0 for i, c in enumerate(self.row_rules(columns))}
        return {c: known.get(c, self.predicate(c, columns)) for c in dict.fromkeys(self.priority)}

    def resolve(self, df: DataFrame, bits: str) -> DataFrame:
        """Add ``dq_flag``, ``dq_issues`` and ``dq_exclusion`` to a frame that carries rule bits."""
        tests = self.predicates_from_bits(bits, df.columns)
        return df.withColumns(
            {
                "dq_flag": first_match(list(tests.items())),
                "dq_issues": all_matches(list(tests.items())),
                "dq_exclusion": first_match([(c, t) for c, t in tests.items() if self.excludes(c)]),
            }
        )


def first_match(tests: list[tuple[str, Column]]) -> Column:
    if not tests:
        return F.lit(None).cast("string")
    (code, test), *others = tests
    chain = F.when(test, F.lit(code))
    for code, test in others:
        chain = chain.when(test, F.lit(code))
    return chain


def all_matches(tests: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in tests]).cast("array<string>"))


def split_by_action(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """Rows that go on, and rows that do not with the reason why.  A rule whose test is NULL has
    not been broken, so every row is in exactly one of the two."""
    judged = df.withColumn("reason", rules.exclusion(df.columns))
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())
