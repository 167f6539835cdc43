"""Loading delimited lines while separating those that do not parse.

Blocks of lines are parsed with the columnar CSV reader and validated with
column kernels. Lines that a kernel already shows to be no plain rows are taken
out of the block at once; if what is left still fails, the block is cut in
halves, again and again, until the bad lines stand alone. Only the lines that
were isolated are read character by character to find the reason. Good lines
never pass the slow path, and no good line is parsed twice because of a bad
neighbour that a kernel can see.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import unused_name

#: Lines in the first block that is tried.
BLOCK_LINES = 4096
#: A field that opens with a quote closes at its end; any other has no rule.
STRICT_LINE = r'^(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)(?:\t(?:"(?:[^"]|"")*"|[^"\t][^\t]*|))*$'


@dataclass(frozen=True)
class LineRules:
    """What a valid line of one feed is."""

    n_fields: int
    id_pattern: str
    id_field: int


def split_strict(line: str) -> list[str] | None:
    """Fields of a line; None if its quoting is broken."""
    fields, i, n = [], 0, len(line)
    while True:
        if i < n and line[i] == '"':
            out, i = [], i + 1
            while True:
                j = line.find('"', i)
                if j < 0:
                    return None
                out.append(line[i:j])
                if j + 1 < n and line[j + 1] == '"':
                    out.append('"')
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < n and line[i] != "\t":
                return None
            fields.append("".join(out))
        else:
            j = line.find("\t", i)
            j = n if j < 0 else j
            fields.append(line[i:j])
            i = j
        if i >= n:
            return fields
        i += 1


def diagnose(line: str | None, rules: LineRules) -> tuple[str | None, list[str] | None]:
    """(reason, None) of a bad line or (None, fields) of a good one; a null line has no fields."""
    if line is None:
        return "column_count", None
    if line.endswith("\r"):
        line = line[:-1]
    fields = split_strict(line)
    if fields is None:
        return "quoting", None
    if len(fields) != rules.n_fields:
        return "column_count", None
    if not re.fullmatch(rules.id_pattern, fields[rules.id_field]):
        return "entity_id", None
    return None, fields


def _bulk(lines: pa.StringArray, rules: LineRules) -> list[pa.Array] | None:
    """All fields of a block as columns, or None if the reader can't split every line into as many fields."""
    names = [f"f{i}" for i in range(rules.n_fields)]
    data = "\n".join(lines.to_pylist()).encode() + b"\n"
    try:
        table = pacsv.read_csv(
            io.BytesIO(data),
            read_options=pacsv.ReadOptions(column_names=names, use_threads=False, block_size=len(data) + 1),
            parse_options=pacsv.ParseOptions(delimiter="\t", quote_char='"', double_quote=True, newlines_in_values=False, ignore_empty_lines=False),
            convert_options=pacsv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=False, quoted_strings_can_be_null=False),
        )
    except (pa.ArrowInvalid, pa.ArrowKeyError):
        return None
    return [table.column(n).combine_chunks() for n in names] if table.num_rows == len(lines) else None


def _plain(lines: pa.StringArray, rules: LineRules) -> np.ndarray:
    """Which lines (without their carriage return) kernels can't tell from good ones."""
    ok = pc.and_(pc.match_substring_regex(lines, STRICT_LINE), pc.invert(pc.match_substring_regex(lines, "[\r\n]")))
    tabs = pc.equal(pc.count_substring(lines, "\t"), rules.n_fields - 1)
    ok = pc.and_(ok, pc.or_(tabs, pc.match_substring(lines, '"')))
    if rules.n_fields == 1:  # the reader takes an empty line for none
        ok = pc.and_(ok, pc.not_equal(lines, ""))
    return pc.fill_null(ok, False).to_numpy(zero_copy_only=False)


def parse_block(lines: pa.StringArray, rules: LineRules) -> tuple[pa.Array, list[pa.Array]]:
    """Reasons (null: good) and fields of all lines."""
    clean = pc.replace_substring_regex(lines, "\r$", "")
    places = np.flatnonzero(_plain(clean, rules))
    plain = clean.take(pa.array(places))
    good: list[np.ndarray] = []
    columns: list[list[pa.Array]] = [[] for _ in range(rules.n_fields)]
    todo = [(0, len(plain))] if len(plain) else []
    while todo:
        a, b = todo.pop()
        got = _bulk(plain.slice(a, b - a), rules)
        if got is not None:
            named = pc.and_(pc.match_substring_regex(got[rules.id_field], f"^(?:{rules.id_pattern})$"), pc.invert(pc.match_substring(got[rules.id_field], "\n")))
            keep = named.to_numpy(zero_copy_only=False)
            good.append(places[a:b][keep])
            for column, part in zip(columns, got):
                column.append(part.filter(named))
        elif b - a > 1:
            mid = (a + b) // 2
            todo += [(mid, b), (a, mid)]
    at = np.concatenate([*good, np.zeros(0, np.int64)]).astype(np.int64)
    rest = np.setdiff1d(np.arange(len(lines)), at)
    judged = [diagnose(x, rules) for x in lines.take(pa.array(rest, pa.int64())).to_pylist()]
    order = pa.array(np.argsort(np.concatenate((at, rest)), kind="stable"))
    reasons = pa.array([None] * len(at) + [r for r, _ in judged], pa.string()).take(order)
    out = []
    for i, column in enumerate(columns):
        late = pa.array([f[i] if f else None for _, f in judged], pa.string())
        out.append(pa.concat_arrays([*column, late]).take(order))
    return reasons, out


def parse_lines(df: DataFrame, line: str, feed: str, feeds: dict[str, str], fields: list[str], id_field: str, label_field: str, labels: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Each row of df with the fields of its line, or the reason why it has none.

    line, feed: the columns with the line and the name of its feed. feeds: the
    id pattern of each feed. Adds `fields` (strings) and `reason`, which is null
    for a valid line. The first that applies of quoting, column_count, entity_id
    and country is given. A null line counts as column_count; a feed that isn't
    listed has no valid id; an empty quoted or unquoted field is the empty
    string. A column of df named like a new one raises ValueError. labels: the
    valid values of label_field in its first column, of any number: they are
    joined, not shipped. Repeated rows stay repeated; an empty frame stays empty.
    """
    new = [*fields, "reason"]
    if clash := {c.lower() for c in df.columns} & {c.lower() for c in new}:
        raise ValueError(f"df already has {sorted(clash)}")
    kept = df.columns
    rules = {name: LineRules(len(fields), pattern, fields.index(id_field)) for name, pattern in feeds.items()}
    unknown = LineRules(len(fields), r"[^\s\S]", fields.index(id_field))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(kept.index(feed))
            for name in pc.unique(names).to_pylist():
                part = batch.filter(pc.is_null(names) if name is None else pc.equal(names, name))
                for at in range(0, part.num_rows, block_lines):
                    block = part.slice(at, block_lines)
                    reasons, values = parse_block(block.column(kept.index(line)).cast(pa.string()), rules.get(name, unknown))
                    yield pa.RecordBatch.from_arrays([*block.columns, *values, reasons], names=[*kept, *new])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], *[f"`{f}` string" for f in new]])
    parsed = df.mapInArrow(run, schema)
    known, mark = unused_name("_label", parsed), unused_name("_known", parsed)
    valid = labels.select(F.col(labels.columns[0]).alias(known)).where(F.col(known).isNotNull()).distinct().withColumn(mark, F.lit(True))
    joined = parsed.join(valid, F.col(f"`{label_field}`") == F.col(known), "left")
    reason = F.coalesce(F.col("reason"), F.when(F.col(mark).isNull(), F.lit("country")))
    judged = joined.withColumn("reason", reason)
    return judged.select(*[F.col(f"`{c}`") for c in kept], *[F.when(F.col("reason").isNull(), F.col(f"`{f}`")).alias(f) for f in fields], "reason")
