"""Pages in SQL: a function whose blocks are read with LATERAL."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leafmill.functions.markup import NODES, PageNodes, slices
from leafmill.session import ship_code


def register_page_blocks(
    spark: SparkSession, name: str = "page_blocks", attributes: Sequence[str] = (), links: bool = False
) -> None:
    """Register `name(body, url, tag, class)`: an array with a block for every element of that tag and class, in document order.

    A block is the element with all that lies below it, as `page_nodes` gives nodes, so
    that SQL reads values with `filter` and `transform` and needs no join:
    `FROM pages, LATERAL posexplode(page_blocks(body, url, 'div', 'quote')) AS b(pos, nodes)`.
    A null class stands for any, a null tag for any element; a null body has no blocks.
    Only the named attributes are kept, and links if asked for: register one function per
    site. Pages go to Python in Arrow batches, which table functions in Python may not do
    behind LATERAL.
    """
    keep = frozenset(attributes)
    ship_code()

    @F.arrow_udf(f"array<{NODES}>")
    def blocks(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, urls, tags, classes in slices(batches):
            nodes, taken, first = PageNodes(keep, links), [], 0
            for body, url, tag, cls in zip(*(a.to_pylist() for a in (bodies, urls, tags, classes)), strict=True):
                nodes.page(body or "", url or "")
                taken.append(nodes.elements(tag, cls, first))
                first = nodes.pages[-1]
            whole = nodes.array().values
            parts = [whole.slice(at, size) for found in taken for at, size in found]
            below = pa.concat_arrays(parts) if parts else whole.slice(0, 0)
            inner = pa.ListArray.from_arrays(pa.array(_ends(map(len, parts)), pa.int32()), below)
            yield pa.ListArray.from_arrays(pa.array(_ends(map(len, taken)), pa.int32()), inner)

    spark.udf.register(name, blocks)


def _ends(sizes) -> list[int]:
    ends = [0]
    for size in sizes:
        ends.append(ends[-1] + size)
    return ends
