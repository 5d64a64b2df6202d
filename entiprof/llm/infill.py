"""Fill-in-middle transformation: texts cut at line bounds by an indexable skip list.

A text's lines are the nodes of a skip list. The link of every lane carries how
many lines and how many code points it passes, so a descent from the top lane,
adding up widths, reaches the place of a line number and its code point in
logarithmic time. Two line numbers drawn from a hash of the document's id cut
the text into prefix, middle and suffix, which sentinels join in one of two
orders. :func:`restore` rebuilds the text from output and form alone.

Null text is empty and stays plain; a null id is drawn as empty digits. Repeated
rows give one result each; an empty table gives an empty one; other columns, of
whatever name, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import give_back, row_slices, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)


class SkipList:
    """Lanes of links over the bounds 0 .. n of n units; each lane holds about a quarter of the one below."""

    def __init__(self, widths: list[int]):
        n = len(widths)
        at, units, chars, down = list(range(n + 1)), [1] * n, widths, [0] * (n + 1)
        self.lanes = [(units, chars, down)]
        level = 1
        while len(at) > 5:
            # a bound stands in this lane if the first 2 * level bits of its hash are zero; both ends always do
            kept = [0, *(k for k in range(1, len(at) - 1) if (at[k] * 2654435761 & 0xFFFFFFFF) >> max(0, 32 - 2 * level) == 0), len(at) - 1]
            if len(kept) == len(at):
                break
            total, before = list(accumulate(chars, initial=0)), at
            at, down = [before[k] for k in kept], kept
            units = [b - a for a, b in zip(at, at[1:])]
            chars = [total[b] - total[a] for a, b in zip(kept, kept[1:])]
            self.lanes.append((units, chars, down))
            level += 1

    def chars_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        k = passed = code_points = 0
        for units, chars, down in reversed(self.lanes):
            while k < len(units) and passed + units[k] <= rank:
                passed += units[k]
                code_points += chars[k]
                k += 1
            if passed == rank:
                break
            k = down[k]
        return code_points


def line_widths(text: str) -> list[int]:
    """Code points of each line, its line feed included."""
    *lines, last = text.split("\n")
    return [len(x) + 1 for x in lines] + ([len(last)] if last else [])


def cut(text: str, doc_id: int | None, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> tuple[int, str, int | None, int | None, str]:
    """Lines, form, code points of prefix and of middle, output."""
    widths = line_widths(text)
    n = len(widths)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    lanes = SkipList(widths)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lanes.chars_before(a), lanes.chars_before(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def infill(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id, n (lines), form (plain, psm, spm), prefix_chars, middle_chars, output.

    ``percent`` of the documents are transformed, ``spm_percent`` of these suffix first; ``seed`` varies the draw.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in row_slices(whole, "text"):
                made = [cut(t, k, seed, percent, spm_percent) for k, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())]
                n, form, prefix, middle, output = map(list, zip(*made))
                columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
        give_back()

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """The rows of :func:`infill` with the text rebuilt from form and output, as column ``restored``.

    A text that holds a sentinel is plain, and no sentinel can begin inside another, so a transformed
    output falls into its parts at exactly three places.
    """
    parts = F.split("output", "|".join(SENTINELS), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return transformed.withColumn("restored", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("output")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`infill` and :func:`restore` with digests in place of the texts."""
    done = restore(infill(docs, id_col, text_col))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


#: The same rows in DuckDB SQL.
ORACLE_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS cells,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), lines AS (
  SELECT doc_id, t, len(cells) - CASE WHEN cells[-1] = '' THEN 1 ELSE 0 END AS n, cells,
         CAST('0x' || substr(h, 1, 8) AS UBIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS UBIGINT) AS h2,
         CAST('0x' || substr(h, 25, 8) AS UBIGINT) AS h4
  FROM drawn
), ranks AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM lines
), places AS (
  SELECT doc_id, t, n, form,
         CAST(CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(t) ELSE length(array_to_string(cells[1:CAST(a AS BIGINT)], chr(10))) + 1 END AS BIGINT) AS p,
         CAST(CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(t) ELSE length(array_to_string(cells[1:CAST(b AS BIGINT)], chr(10))) + 1 END AS BIGINT) AS q
  FROM ranks
), parts AS (
  SELECT *, substr(t, 1, p) AS pre, substr(t, p + 1, q - p) AS mid, substr(t, q + 1) AS suf FROM places
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM parts
"""
