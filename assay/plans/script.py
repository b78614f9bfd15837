"""A contract as a Spark SQL script that people can read, review and run by hand.

The script does what transform, guards and publish do with DataFrames: clean and type by common
table expressions, stop at rows that break a guard, create the tables and fill them, parents first,
and check references and counts at the end. Its constants are those of the DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import Path
from textwrap import indent

from pyspark.sql import SparkSession

from assay.config import CURRENCY_ALIASES, KEY_LENGTH, NULL_MARKERS
from assay.functions import clean
from assay.functions.names import comment, constraint_name, is_currency_column, literal, quoted
from assay.operators import guards
from assay.operators.transform import CLEANED, mapping_of, target_columns
from assay.plans import order
from assay.plans.contract import Contract, ContractError, Conversion, TableSpec, refuse_blocked, validate
from assay.types import LOGICAL

_STEP = "    "


def _texts(values: Iterable[str]) -> str:
    return ", ".join(map(literal, values))


def _cases(key: str, mapping: Mapping[str, str], otherwise: str) -> str:
    """CASE over the values of key; just `otherwise` without any."""
    whens = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE {otherwise} END" if whens else otherwise


def cleaned(table: TableSpec, contract: Contract, name: str) -> str:
    """The cleaned text of a column, over the raw one."""
    spec = table.column(name)
    c = f"CAST({quoted(spec.source)} AS STRING)"
    if table.fixes("MISSING_VALUE", "STANDARDIZE_NULL_MARKERS", spec.name):
        c = f"CASE WHEN lower(trim({c})) NOT IN ({_texts(NULL_MARKERS)}) THEN {c} END"
    if table.fixes("WHITESPACE", "STANDARDIZE_TEXT", spec.name):
        c = rf"trim(regexp_replace({c}, r'[ \t\r\n]+', ' '))"
    if table.fixes("TEXT_VARIANT", "APPLY_VALUE_MAPPING", spec.name):
        c = _cases(f"lower(trim({c}))", {k.strip().lower(): v for k, v in mapping_of(table, spec.name).items()}, c)
    if is_currency_column(spec.name):
        known = {k.strip().upper(): v.strip().upper() for k, v in (CURRENCY_ALIASES | dict(contract.aliases)).items()}
        c = _cases(f"upper(trim({c}))", known, f"upper(trim({c}))")
    return c


def number(c: str) -> str:
    """A text as DECIMAL(38,10), null if it isn't a number."""
    plain = f"replace(trim({c}), ',', '')"
    text = rf"CASE WHEN {plain} RLIKE r'^\(.*\)$' THEN concat('-', regexp_extract({plain}, r'^\((.*)\)$', 1)) ELSE {plain} END"
    return f"CASE WHEN {text} RLIKE r'{clean._NUMBER}' THEN try_cast({text} AS DECIMAL(38,10)) END"


def timestamp(c: str) -> str:
    whens = []
    for i, (shape, pattern) in enumerate(clean.DATE_SHAPES):
        source = f"regexp_replace(trim({c}), 'T', ' ')" if i == 0 else f"trim({c})"
        whens.append(f"WHEN trim({c}) RLIKE r'{shape}' THEN CAST(try_to_timestamp({source}, {literal(pattern)}) AS TIMESTAMP_NTZ)")
    return f"CASE {' '.join(whens)} END"


def typed(c: str, parsed: str, datatype: str) -> str:
    """A cleaned text c as a value of a logical type; parsed: its number or timestamp."""
    flag = f"CASE WHEN lower(trim({c})) IN ({_texts(clean.TRUE_TEXTS)}) THEN true WHEN lower(trim({c})) IN ({_texts(clean.FALSE_TEXTS)}) THEN false END"
    return {
        "string": c, "decimal": parsed, "integer": f"CASE WHEN floor({parsed}) = {parsed} THEN try_cast({parsed} AS BIGINT) END",
        "date": f"CAST({parsed} AS DATE)", "datetime": parsed, "boolean": flag,
    }[datatype]


def _rated(conversion: Conversion, base: str, before: str, rates: str) -> str:
    """A conversion's rate and amount beside the rows of the step before."""
    currency, day = (f"t.{quoted(c)}" for c in (conversion.currency_column, conversion.date_column))
    same = f"r.currency = {currency} AND CAST({day} AS DATE) "
    if conversion.missing_rate_rule == "exact":
        held, met = rates, f"{same}= r.date"
    else:
        held = f"(SELECT *, lead(date) OVER (PARTITION BY currency ORDER BY date) AS held_to FROM {rates})"
        met = f"{same}>= r.date AND (r.held_to IS NULL OR CAST({day} AS DATE) < r.held_to)"
    rate = f"CASE WHEN {currency} = {literal(base)} THEN CAST(1 AS DECIMAL(38,10)) ELSE r.rate END"
    amount = f"CAST(CAST(t.{quoted(conversion.amount_column)} AS DECIMAL(38,10)) * ({rate}) AS DECIMAL(38,10))"
    return f"SELECT t.*, {rate} AS {quoted(conversion.rate_output_column)}, {amount} AS {quoted(conversion.output_column)}\nFROM {before} t LEFT JOIN {held} r ON {met}"


def select(table: TableSpec, contract: Contract, source: str, rates: str) -> str:
    """The typed rows of a raw table, with the cleaned texts of typed columns, as one SELECT."""
    columns = [quoted(c.name) for c in table.columns]
    first = ",\n".join(f"{cleaned(table, contract, c.name)} AS {q}" for c, q in zip(table.columns, columns))
    parsers = {"integer": number, "decimal": number, "date": timestamp, "datetime": timestamp}
    parsed = [f"{parsers[c.datatype](q)} AS {quoted('__parsed_' + c.name)}" for c, q in zip(table.columns, columns) if c.datatype in parsers]
    last = [f"{typed(q, quoted('__parsed_' + c.name), c.datatype)} AS {q}" for c, q in zip(table.columns, columns)]
    last += [f"{q} AS {quoted(CLEANED + c.name)}" for c, q in zip(table.columns, columns) if c.datatype != "string"]
    steps = [("cleaned", f"SELECT\n{indent(first, _STEP)}\nFROM {source}"), ("parsed", "SELECT\n" + indent(",\n".join(["*", *parsed]), _STEP) + "\nFROM cleaned")]
    steps.append(("typed", "SELECT\n" + indent(",\n".join(last), _STEP) + "\nFROM parsed"))
    for i, conversion in enumerate(table.conversions, 1):
        steps.append((f"rated{i}", _rated(conversion, contract.base_currency, steps[-1][0], rates)))
    listed = ",\n".join(f"{name} AS (\n{indent(body, _STEP)}\n)" for name, body in steps)
    return f"WITH {listed}\nSELECT * FROM {steps[-1][0]}"


def conditions(table: TableSpec) -> list[tuple[str, str, str]]:
    """(code, column, condition of a bad row) of every row guard, in the order of guards.row_guards()."""
    found, keyed = [], set(table.primary_key) | {fk.column for fk in table.foreign_keys}
    for c in table.columns:
        q = quoted(c.name)
        if c.datatype != "string":
            found.append((guards.DATATYPE, c.name, f"{quoted(CLEANED + c.name)} IS NOT NULL AND {q} IS NULL"))
        elif c.name in keyed:
            found.append((guards.KEY_TOO_LONG, c.name, f"octet_length(encode({q}, 'UTF-16LE')) > {2 * KEY_LENGTH}"))
        if not c.nullable:
            found.append((guards.NOT_NULL, c.name, f"{q} IS NULL"))
        if c.name in table.primary_key:
            found.append((guards.KEY_NULL, c.name, f"{q} IS NULL"))
    for c in table.conversions:
        amount, currency, rate = map(quoted, (c.amount_column, c.currency_column, c.rate_output_column))
        found.append((guards.MISSING_RATE, c.rate_output_column, f"{amount} IS NOT NULL AND {currency} IS NOT NULL AND {rate} IS NULL"))
    return found


def _guards(table: TableSpec, rows: str, result: str) -> str:
    """(code, column_name, bad_rows) of a table's guards: rows in one pass, repeated keys in one grouping."""
    listed = conditions(table)
    counts = ",\n".join(f"count_if({condition}) AS g{i}" for i, (*_, condition) in enumerate(listed))
    named = ",\n".join(f"struct({literal(code)} AS code, {literal(name)} AS column_name, g{i} AS bad_rows)" for i, (code, name, _) in enumerate(listed))
    text = f"SELECT inline(array(\n{indent(named, _STEP)}\n))\nFROM (\nSELECT\n{indent(counts, _STEP)}\nFROM {rows}\n)"
    if table.primary_key:
        key = ", ".join(map(quoted, table.primary_key))
        again = f"SELECT {key} FROM ({result}) GROUP BY {key} HAVING count(*) > 1"
        text += f"\nUNION ALL\nSELECT {literal(guards.KEY_TWICE)}, {literal('+'.join(table.primary_key))}, count(*) FROM ({again})"
    return text


def _stop(table: str, found: str) -> str:
    """A statement that fails with all that was found, if anything was."""
    line = f"concat(code, {literal(f' {table}.')}, column_name, ': ', bad_rows, ' rows')"
    gathered = f"SELECT count(*) AS n, array_join(sort_array(collect_list({line})), '\\n') AS lines FROM {found} WHERE bad_rows > 0"
    return f"SELECT CASE WHEN n > 0 THEN raise_error(lines) END AS stop\nFROM ({gathered})"


def statements(contract: Contract, sources: Mapping[str, str], database: str, rates: str = "fx_rates") -> list[tuple[str, str]]:
    """(what it does, statement) of the whole script. sources: the raw tables by source name, as SQL
    names; rates: the table or view (currency, date, rate) of exchange rates.

    ContractError lists all that is wrong with the contract, blocking decisions included.
    """
    if errors := validate(contract):
        raise ContractError(errors)
    refuse_blocked(contract)
    relations = contract.relationships()
    steps = [("the database", f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")]
    for name in (n for level in order.levels(contract) for n in level):
        table = contract.table(name)
        rows, found, target = quoted(f"{name}__rows"), quoted(f"{name}__guards"), quoted(database, name)
        columns = target_columns(table)
        distinct = "DISTINCT " if table.fixes("EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES") else ""
        result = f"SELECT {distinct}{', '.join(map(quoted, columns))} FROM {rows}"
        decided = "\n".join(comment(f"{d.decision} {d.issue_type} {d.column or '(table)'} {d.action} {d.reason}") for d in table.decisions)
        steps.append((f"{table.source}: clean and type", f"{decided}\nCREATE OR REPLACE TEMPORARY VIEW {rows} AS\n{select(table, contract, sources[table.source], rates)}".lstrip()))
        steps.append((f"{name}: count rows that break a guard", f"CREATE OR REPLACE TEMPORARY VIEW {found} AS\n{_guards(table, rows, result)}"))
        steps.append((f"{name}: stop at any", _stop(name, found)))
        kinds = {c.name: c for c in table.columns}
        keyed = set(table.primary_key) | {fk.column for fk in table.foreign_keys}

        def kind(c: str) -> str:
            if c in keyed and kinds[c].datatype == "string":
                return f"VARCHAR({KEY_LENGTH})"
            return LOGICAL[kinds[c].datatype if c in kinds else "decimal"].simpleString()

        listed = ",\n".join(f"{quoted(c)} {kind(c)}" for c in columns)
        steps.append((f"{name}: the table; it mustn't be there yet", f"CREATE TABLE {target} (\n{indent(listed, _STEP)}\n) USING parquet"))
        steps.append((f"{name}: fill it", f"INSERT INTO {target}\n{result}"))
        for t, c, parent, pc in relations:
            if t == name:
                lost = f"SELECT 'FK_ORPHAN' AS code, {literal(c)} AS column_name, count(*) AS bad_rows FROM {target} c\nLEFT ANTI JOIN {quoted(database, parent)} p ON c.{quoted(c)} = p.{quoted(pc)} WHERE c.{quoted(c)} IS NOT NULL"
                steps.append((f"{constraint_name('fk', name, c)}: stop at rows without a {parent}", _stop(name, f"({lost})")))
    counts = "\nUNION ALL ".join(f"SELECT {literal(t.name)} AS table_name, count(*) AS row_count FROM {quoted(database, t.name)}" for t in contract.tables)
    return [*steps, ("how many rows each table got", counts)]


def script(contract: Contract, sources: Mapping[str, str], database: str, rates: str = "fx_rates") -> str:
    """The statements as one text, the same for the same contract: a header, relationships, and each
    statement under a line that says what it does."""
    lines = [comment(f"Builds {len(contract.tables)} tables in {database}"), *(comment(f"{t}.{c} references {p}.{pc}") for t, c, p, pc in contract.relationships())]
    parts = [f"{comment(what)}\n{text};" for what, text in statements(contract, sources, database, rates)]
    return "\n".join(lines) + "\n\n" + "\n\n".join(parts) + "\n"


def write_script(path: str | Path, contract: Contract, sources: Mapping[str, str], database: str, rates: str = "fx_rates") -> None:
    Path(path).write_text(script(contract, sources, database, rates), encoding="utf-8")


def run(spark: SparkSession, contract: Contract, sources: Mapping[str, str], database: str, rates: str = "fx_rates", stop: bool = True) -> None:
    """Run the statements one after the other; stop=False runs those that clean, type and count only."""
    for what, text in statements(contract, sources, database, rates):
        if stop or "VIEW" in text.split(" AS\n")[0]:
            spark.sql(text).collect()  # at most one row a table
