"""Attribute-value rows into wide tables with typed columns.

Rows are combined to one per cell before they move, then sorted by entity, and
streamed through builders: each attribute has a column index, each column an
index buffer with a validity mask, and a typed column is taken from the typed
values of the batch by that buffer. The next entity begins where the key
changes, across batches too. A task holds a batch and the cells of one entity.

Attributes of the schema become columns of their own; the rest, whose number
grows with the data, go into one sparse column, a map from name to text. The
ids of the rows that filled the cells stand in a map beside them.

Defined results: rows with a null entity or attribute fill no cell; of several
rows for a cell the one with the greatest version wins, with equal versions
the smallest id, a null version last; an entity whose rows all fail to fill a
cell has no row; columns of the input with clashing names do no harm, as only
the named ones are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of typed columns and where a reading of each is held.
KINDS = {"number": ("n", "decimal(38,8)"), "text": ("t", "string"), "boolean": ("b", "boolean"), "date": ("d", "date")}
FLUSH_ROWS = 4096


def column_name(attribute: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", attribute).strip("_")


def cells(df: DataFrame, entity: list[str], attribute: str, readings: dict[str, str], version: str, row_id: str) -> DataFrame:
    """(entity..., attribute, n, t, b, d, id): the winning row of each cell; combined before the shuffle.

    ``readings`` maps the holders n, t, b and d to columns of ``df``.
    """
    held = F.struct(*[F.col(readings[h]).alias(h) if h in readings else F.lit(None).cast(k).alias(h) for h, k in KINDS.values()], F.col(row_id).alias("id"))
    rank = F.struct(F.col(version).isNotNull(), F.col(version), -F.col(row_id))
    keyed = df.where(F.col(attribute).isNotNull()).dropna(subset=entity)
    best = keyed.groupBy(*entity, F.col(attribute).alias("attribute")).agg(F.max_by(held, rank).alias("held"))
    return best.select(*entity, "attribute", "held.*")


def _builder(entity: list[str], index: dict[str, int], holders: list[str]):
    def build(rows: pa.Table) -> pa.RecordBatch:
        n = rows.num_rows
        new = np.zeros(n, bool)
        new[0] = True
        for key in entity:
            codes = rows.column(key).combine_chunks().dictionary_encode()
            codes = codes.indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        line = np.cumsum(new) - 1
        count = int(line[-1]) + 1
        begins = np.flatnonzero(new)
        names = rows.column("attribute").to_pylist()
        column = np.fromiter((index.get(a, -1) for a in names), np.int64, n)
        out = [rows.column(key).take(pa.array(begins)) for key in entity]
        by_column = np.argsort(column, kind="stable")
        edges = np.searchsorted(column[by_column], np.arange(len(holders) + 1))
        for c, holder in enumerate(holders):
            at = by_column[edges[c] : edges[c + 1]]
            buffer = np.zeros(count, np.int64)
            empty = np.ones(count, bool)
            buffer[line[at]], empty[line[at]] = at, False
            out.append(rows.column(holder).take(pa.array(buffer, mask=empty)))
        spare = by_column[: edges[0]] if len(holders) else by_column
        spare = np.sort(spare)
        held = np.bincount(line[spare], minlength=count)
        offsets = pa.array(np.concatenate(([0], np.cumsum(held))).astype(np.int32))
        out.append(pa.MapArray.from_arrays(offsets, rows.column("attribute").take(pa.array(spare)).combine_chunks(), rows.column("t").take(pa.array(spare)).combine_chunks()))
        offsets = pa.array(np.append(begins, n).astype(np.int32))
        out.append(pa.MapArray.from_arrays(offsets, rows.column("attribute").combine_chunks(), rows.column("id").combine_chunks()))
        flat = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in out]
        return pa.record_batch(flat, [str(i) for i in range(len(flat))])

    def work(batches):
        pending: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            pending.append(b)
            size += b.num_rows
            if size < FLUSH_ROWS:
                continue
            rows = pa.Table.from_batches(pending)
            # the last entity may go on in the next batch
            last = rows.slice(rows.num_rows - 1)
            same = np.ones(rows.num_rows, bool)
            for key in entity:
                same &= pc.equal(rows.column(key), last.column(key)[0]).to_numpy(zero_copy_only=False)
            keep = rows.num_rows - int(same[::-1].argmin() if not same.all() else rows.num_rows)
            if keep:
                yield build(rows.slice(0, keep))
            rest = rows.slice(keep).combine_chunks()
            pending, size = rest.to_batches(), 0 if keep else rest.num_rows
        if pending:
            yield build(pa.Table.from_batches(pending).combine_chunks())

    return work


def widen(found: DataFrame, entity: list[str], schema: dict[str, str]) -> DataFrame:
    """One row per entity of ``cells``: a typed column per attribute of ``schema`` (attribute to kind), ``others`` and ``row_ids``."""
    names = [column_name(a) for a in schema]
    if len({n.lower() for n in [*names, *entity, "others", "row_ids"]}) != len(names) + len(entity) + 2:
        raise ValueError("attributes or entity columns of the same name")
    holders = [KINDS[kind][0] for kind in schema.values()]
    fields = [found.schema[e] for e in entity]
    fields += [T.StructField(n, T._parse_datatype_string(KINDS[kind][1])) for n, kind in zip(names, schema.values())]
    fields += [T.StructField("others", T._parse_datatype_string("map<string,string>")), T.StructField("row_ids", T.MapType(T.StringType(), found.schema["id"].dataType))]
    order = [*entity, "attribute"]
    sorted_rows = found.repartition(*entity).sortWithinPartitions(*order)
    worker = _builder(entity, {a: i for i, a in enumerate(schema)}, holders)

    def named(batches):
        out = [f.name for f in fields]
        for b in worker(batches):
            yield b.rename_columns(out)

    return sorted_rows.mapInArrow(named, T.StructType(fields))


def filled_cells(wide: DataFrame, entity: list[str]) -> DataFrame:
    """(entity..., attribute, id): the cells of a wide table and the rows that filled them."""
    return wide.select(*entity, F.explode("row_ids").alias("attribute", "id"))
