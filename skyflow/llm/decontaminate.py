"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item with q shingles is contained in a document when the document has at least
ceil(t * q) of them. Any such document must hold one of the item's k = q - ceil(t * q) + 1
smallest shingle hashes: it lacks too few to miss them all. These k minima are the item's MinHash
sketch, so the search finds every containing document, however long, and k follows the item's size.
Items are partitioned by size class; a document probes only the classes whose items it can hold.
Candidates are counted over the full shingle sets and then verified on the words themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyflow.llm.common import shingle_sets, text_of, tune

#: Shingles of the items in one broadcast block (8 bytes and the text each); a larger benchmark runs in several blocks.
BLOCK_SHINGLES = 500_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def needed(q: int, percent: int) -> int:
    """Least overlap: 100 * overlap >= percent * q."""
    return -(-percent * q // 100)


def word_shingles(text: str, width: int) -> set[tuple[str, ...]]:
    w = _WORD.findall(text.translate(_AZ))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


class ItemIndex:
    """One block of items: by size class their sketches, and all their shingles for counting."""

    def __init__(self, items: list[tuple[object, str]], width: int, percent: int):
        self.ids, self.texts, self.width, self.percent = [i for i, _ in items], [t for _, t in items], width, percent
        sets = list(shingle_sets(pa.array(self.texts, pa.string()), width))
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.least = np.array([needed(len(s), percent) for s in sets], dtype=np.int64)
        self.classes = []
        for c in sorted({int(q).bit_length() for q in self.sizes if q}):
            own = [k for k, s in enumerate(sets) if len(s).bit_length() == c]
            # int64 order of the hashes is the permutation
            sketch = [(h, k) for k in own for h in sets[k][: len(sets[k]) - self.least[k] + 1]]
            hashes = np.array([h for h, _ in sketch], dtype=np.int64)
            order = np.argsort(hashes, kind="stable")
            self.classes.append((int(min(self.least[own])), hashes[order], np.array([k for _, k in sketch])[order]))
        self.sets = sets

    def candidates(self, doc: np.ndarray) -> np.ndarray:
        found = []
        for least, hashes, owner in self.classes:
            if len(doc) < least:
                break
            at = np.searchsorted(doc, hashes)
            at[at == len(doc)] = 0
            found.append(owner[doc[at] == hashes])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)

    def search(self, doc: np.ndarray, text: str) -> Iterator[tuple[object, int, int]]:
        """(item id, item size, overlap) of every contained item."""
        words = None
        for k in self.candidates(doc):
            own = self.sets[k]
            at = np.searchsorted(doc, own)
            at[at == len(doc)] = 0
            if int((doc[at] == own).sum()) >= self.least[k]:
                words = words if words is not None else word_shingles(text, self.width)
                item = word_shingles(self.texts[k], self.width)
                overlap = len(item & words)
                if overlap >= needed(len(item), self.percent):
                    yield self.ids[k], len(item), overlap


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The stated query set, in blocks of bounded size."""
    block, size = [], 0
    for r in items.select(items[id_col].alias("id"), text_of(items, text_col).alias("text")).toLocalIterator():
        block.append((r["id"], r["text"]))
        size += len(r["text"]) // 4 + 1
        if size >= BLOCK_SHINGLES:
            yield block
            block, size = [], 0
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = 5, percent: int = 80) -> DataFrame:
    """Find every (document, item) with at least ``percent`` of the item's shingles in the document.

    Returns the id, the item's id, ``n_shingles`` (the item's), ``overlap``, ``containment``. Words are
    split at ASCII white space, A-Z lower-cased. An item of fewer than ``width`` words is one shingle,
    held by texts of just these words; items without words match nothing, as do null and empty texts.
    Repeated rows answer each for itself. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    tune(spark)
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    item_type = to_arrow_type(items.schema[item_col].dataType)
    schema = f"id {kinds[0]}, item {kinds[1]}, n_shingles bigint, overlap bigint"
    out = spark.range(0).select(*(F.lit(None).cast(k).alias(c) for c, k in (("id", kinds[0]), ("item", kinds[1]), ("n_shingles", "bigint"), ("overlap", "bigint"))))
    for block in _blocks(items, item_col, "text"):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(shared.value, width, percent)
            for b in batches:
                found = [(i, *hit) for i, doc, text in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), width), b.column(1)) if len(doc) for hit in index.search(doc, _text(text))]
                cols = list(zip(*found)) if found else [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.column(0).type), pa.array(cols[1], item_type), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["id", "item", "n_shingles", "overlap"])

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_shingles", "overlap", (F.col("overlap") / F.col("n_shingles")).alias("containment"))


def _text(x) -> str:
    return x.as_py()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SHINGLES = r"""
  SELECT {id}, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {table})
"""
ORACLE = f"""
WITH d AS ({SHINGLES.format(id="doc_id", table="documents")}), b AS ({SHINGLES.format(id="item_id", table="benchmark")}),
q AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, overlap, overlap / n_shingles AS containment
FROM (SELECT doc_id, item_id, count(*) AS overlap FROM d JOIN b USING (s) GROUP BY ALL) JOIN q USING (item_id)
WHERE 100 * overlap >= 80 * n_shingles
"""
