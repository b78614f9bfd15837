"""The contract: reviewed schema, decisions and rules, checked before any data is read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace

from assay.config import DECISIONS, DEFAULT_ACTION, SUGGESTED_ACTIONS
from assay.types import logical_type

FIX_ACTIONS = frozenset(SUGGESTED_ACTIONS.values()) | {DEFAULT_ACTION}
SCHEMA_FIELDS = (
    "table_name", "silver_table_name", "allow_no_primary_key", "source_column", "column_name",
    "datatype", "nullable", "is_pk", "pk_order", "is_fk", "fk_reference",
)
DECISION_FIELDS = ("issue_id", "table_name", "column_name", "issue_type", "suggested_action", "decision", "action", "reason")
RATE_RULES = ("previous_available_rate", "exact")


class ContractError(ValueError):
    """All that is wrong with a review, one line each."""

    def __init__(self, errors: Iterable[str]) -> None:
        self.errors = list(errors)
        super().__init__("\n".join(self.errors))


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    name: str
    datatype: str
    nullable: bool = True


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent_table: str
    parent_column: str


@dataclass(frozen=True)
class Decision:
    issue_type: str
    decision: str
    column: str = ""
    action: str = ""
    reason: str = ""
    issue_id: str = ""


@dataclass(frozen=True)
class Conversion:
    """An amount in a currency on a date, converted to the base currency."""

    amount_column: str
    currency_column: str
    date_column: str
    output_column: str
    rate_output_column: str
    missing_rate_rule: str = "previous_available_rate"


@dataclass(frozen=True)
class TableSpec:
    source: str
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    allow_no_primary_key: bool = False
    decisions: tuple[Decision, ...] = ()
    mappings: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    conversions: tuple[Conversion, ...] = ()

    def column(self, name: str) -> ColumnSpec | None:
        """A column by its source or target name, whatever the case."""
        key = name.strip().lower()
        return next((c for c in self.columns if key in (c.name.lower(), c.source.lower())), None)

    def fixes(self, issue_type: str, action: str, column: str = "") -> bool:
        """Whether a fix of an issue is approved, of a column or (blank) of the table."""
        return any(
            d.decision == "FIX" and d.issue_type == issue_type and d.action == action and self._is(d.column, column)
            for d in self.decisions
        )

    def keeps(self, issue_type: str, column: str = "") -> bool:
        return any(d.decision == "KEEP" and d.issue_type == issue_type and self._is(d.column, column) for d in self.decisions)

    def blocking(self) -> list[Decision]:
        return [d for d in self.decisions if d.decision == "BLOCK"]

    def _is(self, named: str, column: str) -> bool:
        if not named or not column:
            return not named and not column
        a, b = self.column(named), self.column(column)
        return a is not None and a == b


@dataclass(frozen=True)
class Contract:
    tables: tuple[TableSpec, ...]
    base_currency: str = "VND"
    aliases: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> TableSpec | None:
        key = name.strip().lower()
        return next((t for t in self.tables if key in (t.source.lower(), t.name.lower())), None)

    def to_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(value: Mapping) -> Contract:
        """The contract that to_dict() gave, also after a way through JSON."""

        def table(t: Mapping) -> TableSpec:
            return TableSpec(
                t["source"], t["name"], tuple(ColumnSpec(**x) for x in t["columns"]), tuple(t["primary_key"]),
                tuple(ForeignKey(**x) for x in t["foreign_keys"]), t["allow_no_primary_key"],
                tuple(Decision(**x) for x in t["decisions"]), t["mappings"], tuple(Conversion(**x) for x in t["conversions"]),
            )

        return Contract(tuple(map(table, value["tables"])), value["base_currency"], value["aliases"])

    def relationships(self) -> list[tuple[str, str, str, str]]:
        """(table, column, parent table, parent column) of every reference, by target names."""
        found = []
        for t in self.tables:
            for fk in t.foreign_keys:
                parent = self.table(fk.parent_table)
                column = parent.column(fk.parent_column) if parent else None
                found.append((t.name, fk.column, parent.name if parent else fk.parent_table, column.name if column else fk.parent_column))
        return found

    def warnings(self) -> list[str]:
        """What isn't wrong but worth a look: tables approved without a key."""
        return [f"{t.source}: no primary key, as approved" for t in self.tables if t.allow_no_primary_key and not t.primary_key]


def _flag(value: object, what: str, errors: list[str]) -> bool:
    text = str(value if value is not None else "").strip().lower()
    if text in ("true", "1", "yes", "y"):
        return True
    if text not in ("false", "0", "no", "n", ""):
        errors.append(f"{what}: {value!r} is neither true nor false")
    return False


def _place(value: object, fallback: int, what: str, errors: list[str]) -> int:
    text = str(value if value is not None else "").strip()
    if not text:
        return fallback
    try:
        if (place := int(float(text))) >= 1:
            return place
    except ValueError:
        pass
    errors.append(f"{what}: {value!r} is no position")
    return fallback


def compile_schema(rows: Iterable[Mapping[str, object]]) -> tuple[list[TableSpec], list[str]]:
    """Tables of a schema review, one row a column, and all that is wrong with it."""
    errors: list[str] = []
    grouped: dict[str, list[dict[str, str]]] = {}
    for row in rows:
        if absent := [f for f in SCHEMA_FIELDS if f not in row]:
            return [], [f"schema review: no column {', '.join(absent)}"]
        clean = {k: "" if v is None else str(v).strip() for k, v in row.items()}
        grouped.setdefault(clean["table_name"], []).append(clean)
    tables, references = [], []
    for source, own in grouped.items():
        names = {r["silver_table_name"] for r in own}
        if len(names) != 1 or not next(iter(names)):
            errors.append(f"{source}: needs one target name, has {sorted(names)}")
        keyless = {_flag(r["allow_no_primary_key"], f"{source}: allow_no_primary_key", errors) for r in own}
        if len(keyless) != 1:
            errors.append(f"{source}: allow_no_primary_key differs between rows")
        columns, keys, foreign = [], [], []
        for i, r in enumerate(own, 1):
            where = f"{source}.{r['source_column'] or i}"
            if not r["source_column"] or not r["column_name"]:
                errors.append(f"{where}: blank column name")
            try:
                datatype = logical_type(r["datatype"])
            except ValueError as error:
                errors.append(f"{where}: {error}")
                datatype = "string"
            columns.append(ColumnSpec(r["source_column"], r["column_name"], datatype, _flag(r["nullable"], f"{where}: nullable", errors)))
            if _flag(r["is_pk"], f"{where}: is_pk", errors):
                keys.append((_place(r["pk_order"], i, f"{where}: pk_order", errors), i, r["column_name"]))
            if _flag(r["is_fk"], f"{where}: is_fk", errors) != bool(r["fk_reference"]):
                errors.append(f"{where}: is_fk and fk_reference disagree")
            elif r["fk_reference"]:
                parent, dot, column = r["fk_reference"].rpartition(".")
                if not dot or not parent or not column:
                    errors.append(f"{where}: fk_reference {r['fk_reference']!r} isn't table.column")
                else:
                    references.append((source, where, ForeignKey(r["column_name"], parent, column)))
                    foreign.append(ForeignKey(r["column_name"], parent, column))
        for what, found in (("source", [c.source for c in columns]), ("target", [c.name for c in columns])):
            if twice := sorted({x for x in found if x and found.count(x) > 1}):
                errors.append(f"{source}: {what} columns twice: {', '.join(twice)}")
        if not keys and keyless != {True}:
            errors.append(f"{source}: no primary key, and none isn't allowed")
        tables.append(
            TableSpec(source, min(names), tuple(columns), tuple(k for *_, k in sorted(keys)), tuple(foreign), keyless == {True})
        )
    whole = Contract(tuple(tables))
    for source, where, fk in references:
        parent = whole.table(fk.parent_table)
        if not parent or not parent.column(fk.parent_column):
            errors.append(f"{where}: no {fk.parent_table}.{fk.parent_column}")
    return tables, errors


def compile_decisions(rows: Iterable[Mapping[str, object]], tables: list[TableSpec]) -> tuple[list[TableSpec], list[str]]:
    """Tables with their decisions, and all that is wrong with these."""
    errors: list[str] = []
    contract = Contract(tuple(tables))
    found: dict[str, list[Decision]] = {}
    for i, row in enumerate(rows, 1):
        if absent := [f for f in DECISION_FIELDS if f not in row]:
            return tables, [f"decisions: no column {', '.join(absent)}"]
        r = {k: "" if v is None else str(v).strip() for k, v in row.items()}
        where = f"decision {i} ({r['table_name']}.{r['column_name']} {r['issue_type']})"
        table = contract.table(r["table_name"])
        verdict, action = r["decision"].upper(), r["action"].upper()
        if not table:
            errors.append(f"{where}: unknown table")
            continue
        if r["column_name"] and not table.column(r["column_name"]):
            errors.append(f"{where}: unknown column")
        if verdict not in DECISIONS:
            errors.append(f"{where}: decision {r['decision']!r} is none of {', '.join(DECISIONS)}")
        if verdict == "FIX":
            action = action or r["suggested_action"].upper()
            if action not in FIX_ACTIONS:
                errors.append(f"{where}: unknown action {action!r}")
        else:
            action = "NONE" if verdict == "KEEP" else "MANUAL_REVIEW"
            if not r["reason"]:
                errors.append(f"{where}: {verdict} needs a reason")
        found.setdefault(table.source, []).append(
            Decision(r["issue_type"].upper(), verdict, r["column_name"], action, r["reason"], r["issue_id"])
        )
    return [replace(t, decisions=tuple(found.get(t.source, ()))) for t in tables], errors


def apply_rules(tables: list[TableSpec], rules: Mapping) -> Contract:
    """A contract from tables and a rules object (`_global` and `tables`)."""
    common = rules.get("_global", {})
    out = []
    for table in tables:
        own = rules.get("tables", {}).get(table.source, {})
        currency = own.get("currency", {})
        rule = currency.get("missing_fx_rate_rule", common.get("missing_fx_rate_rule", RATE_RULES[0]))
        conversions = tuple(Conversion(**c, missing_rate_rule=rule) for c in currency.get("conversions", ()))
        out.append(replace(table, mappings=own.get("value_mappings", {}), conversions=conversions))
    return Contract(tuple(out), common.get("base_currency", "VND"), common.get("currency_aliases", {}))


def validate(contract: Contract) -> list[str]:
    """What would make a contract impossible to carry out."""
    errors = []
    names = [t.name for t in contract.tables]
    errors += [f"target name {n} twice" for n in sorted({n for n in names if names.count(n) > 1})]
    for t in contract.tables:
        for key in t.primary_key:
            if not t.column(key):
                errors.append(f"{t.source}: key column {key} isn't a column")
        for d in t.decisions:
            if d.decision == "FIX" and d.action == "APPLY_VALUE_MAPPING" and not _mapping(t, d.column):
                errors.append(f"{t.source}.{d.column}: no mapping for an approved mapping")
        for fk in t.foreign_keys:
            parent = contract.table(fk.parent_table)
            column = parent and parent.column(fk.parent_column)
            if not column or parent.primary_key != (column.name,):
                errors.append(f"{t.source}.{fk.column}: {fk.parent_table}.{fk.parent_column} isn't the whole primary key")
        outputs = [x for c in t.conversions for x in (c.rate_output_column, c.output_column)] + [c.name for c in t.columns]
        errors += [f"{t.source}: column {n} twice" for n in sorted({n for n in outputs if outputs.count(n) > 1})]
        for c in t.conversions:
            errors += [f"{t.source}: conversion of unknown column {n}" for n in (c.amount_column, c.currency_column, c.date_column) if not t.column(n)]
            if c.missing_rate_rule not in RATE_RULES:
                errors.append(f"{t.source}: unknown missing-rate rule {c.missing_rate_rule!r}")
    return errors


def _mapping(table: TableSpec, column: str) -> Mapping[str, str]:
    spec = table.column(column)
    return next((m for name, m in table.mappings.items() if spec and table.column(name) == spec), {})


def missing_columns(contract: Contract, present: Mapping[str, Iterable[str]]) -> list[str]:
    """Tables and columns of a contract that the sources don't have."""
    errors = []
    for t in contract.tables:
        if t.source not in present:
            errors.append(f"{t.source}: no such table")
        else:
            have = set(present[t.source])
            errors += [f"{t.source}.{c.source}: no such column" for c in t.columns if c.source not in have]
    return errors


def compile_contract(schema: Iterable[Mapping], decisions: Iterable[Mapping], rules: Mapping) -> Contract:
    """The whole compilation; raises ContractError with all errors at once."""
    tables, errors = compile_schema(schema)
    tables, more = compile_decisions(decisions, tables)
    contract = apply_rules(tables, rules) if not errors + more else None
    errors += more + (validate(contract) if contract else [])
    if errors:
        raise ContractError(errors)
    return contract


def refuse_blocked(contract: Contract) -> None:
    blocked = [f"{t.source}.{d.column} {d.issue_type}: {d.reason}" for t in contract.tables for d in t.blocking()]
    if blocked:
        raise ContractError(blocked)


def describe(contract: Contract) -> str:
    """A readable summary: tables, keys, relationships, decisions."""
    lines = []
    for t in contract.tables:
        lines.append(f"{t.source} -> {t.name} (key: {', '.join(t.primary_key) or 'none'})")
        lines += [f"  {c.source} -> {c.name}: {c.datatype}{'' if c.nullable else ' not null'}" for c in t.columns]
        lines += [f"  {fk.column} references {fk.parent_table}.{fk.parent_column}" for fk in t.foreign_keys]
        lines += [f"  {d.decision} {d.issue_type} {d.column or '(table)'}: {d.action} {d.reason}".rstrip() for d in t.decisions]
    return "\n".join(lines) + "\n"
