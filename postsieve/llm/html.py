"""Main text of web pages by wrapper induction.

Pages of a host are brought onto one template: their trees are aligned by simple tree
matching.  Template nodes whose text is (nearly) the same on all pages, or goes
through a few variants, are the host's frame, inside of a marked article, too; the slots
that vary are content.  Tags, classes and roles say which of them are the article.

What is compared are skeletons.  Their number is small where pages are made by
machine, and only different (host, skeleton) pairs are aligned, so a host with a
third of all pages costs little more than another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm import dom
from postsieve.llm.common import small, stored

BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 32_000_000
SALTS = 16
# A slot is constant if one text fills it in this share of at least so many contexts, or if
# many contexts share few texts.
CONSTANT_SHARE, CONSTANT_PAGES = 0.8, 3
VARIANT_SHARE, VARIANT_PAGES = 0.2, 10


def host_of(url: str | None) -> str:
    """Host of a URL in lower case, without user and port; empty without a URL."""
    rest = (url or "").split("//", 1)[-1]
    for mark in "/?#":
        rest = rest.split(mark, 1)[0]
    return rest.rsplit("@", 1)[-1].split(":", 1)[0].lower()


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, skeleton, digest, slots, hashes, sizes) of each page: texts as hashes and lengths per node."""
    for batch in batches:
        rows = []
        for url, page in zip(batch["url"], batch["html"]):  # noqa: B905
            root, blocks = dom.parse(page or "")
            skeleton = dom.write(root)
            texts: dict[int, list[str]] = {}
            for node, text in blocks:
                texts.setdefault(node, []).append(text)
            hashes = [_number("\n".join(parts)) for parts in texts.values()]
            digest = _number(skeleton + repr(sorted(zip(texts, hashes))))  # noqa: B905
            sizes = [sum(map(len, parts)) for parts in texts.values()]
            rows.append((host_of(url), skeleton, digest, list(texts), hashes, sizes))
        yield pd.DataFrame(rows, columns=["host", "skeleton", "digest", "slots", "hashes", "sizes"])


def _templates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Skeletons sorted by (host, salt): one merged template each.  Only the template is held."""
    key, template = None, None
    for batch in batches:
        out = []
        for host, salt, skeleton in batch[["host", "salt", "skeleton"]].itertuples(index=False):
            page = dom.read(skeleton)
            if key == (host, salt):
                template = dom.merge(template, page)
                continue
            if key is not None:
                out.append((*key, dom.write(template)))
            key, template = (host, salt), page
        yield pd.DataFrame(out, columns=["host", "salt", "skeleton"])
    if key is not None:
        yield pd.DataFrame([(*key, dom.write(template))], columns=["host", "salt", "skeleton"])


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The template nodes that are not dropped by tag, class or role, marked or not."""
    for batch in batches:
        keeps = [dom.kept(dom.read(template), set(), set()) for template in batch["template"]]
        yield batch[["host"]].assign(candidates=[[k for k, keep in enumerate(keep) if keep] for keep in keeps])


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each skeleton the template node of each of its nodes."""
    for batch in batches:
        nodes = []
        for skeleton, template in zip(batch["skeleton"], batch["template"]):  # noqa: B905
            page = dom.read(skeleton)
            place = {y.number: x.number for x, y in dom.matches(dom.read(template), page)}
            nodes.append([place.get(k, -1) for k in range(len(dom.order(page)))])
        yield batch[["host", "skeleton"]].assign(nodes=nodes)


def _decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keeps = []
        columns = (batch[c] for c in ("skeleton", "nodes", "constant", "filled"))
        for skeleton, nodes, *sets in zip(*columns):  # noqa: B905
            found = [set() if s is None else set(s) for s in sets]
            keeps.append(dom.kept(dom.read(skeleton), *({k for k, node in enumerate(nodes) if node in s} for s in found)))
        yield batch[["host", "skeleton"]].assign(keep=keeps)


def induce(pages: DataFrame) -> DataFrame:
    """(host, skeleton, keep): the wrapper of every host.

    ``keep`` tells for every node of a skeleton whether its blocks are the article's.
    Pages of a host that are the same in every block count once, and so does what pages
    with the same text in the host's main slot share: copies of an article under other adverts are
    one context.  The main slot is, of those that could be the article, the one with most
    text times the logarithm of its different texts, so neither a long footer nor short
    adverts take its place; it is never constant.
    """
    outlines = pages.select("url", "html").mapInPandas(
        _outlines, "host string, skeleton string, digest long, slots array<int>, hashes array<long>, sizes array<long>"
    )
    outlines = stored(outlines.dropDuplicates(["host", "digest"]))
    skeletons = outlines.groupBy("host", "skeleton").agg(F.count("*").alias("pages"))
    merged = skeletons.withColumn("salt", F.pmod(F.xxhash64("skeleton"), F.lit(SALTS)).cast("int"))
    for salted in (merged, None):
        rows = merged if salted is not None else partial.withColumn("salt", F.lit(0))
        partial = (
            rows.select("host", "salt", "skeleton")
            .repartition("host", "salt")
            .sortWithinPartitions("host", "salt", "skeleton")
            .mapInPandas(_templates, "host string, salt int, skeleton string")
        )
    templates = partial.select("host", F.col("skeleton").alias("template"))
    aligned = stored(
        skeletons.join(templates, "host").mapInPandas(_aligned, "host string, skeleton string, nodes array<int>")
    )
    placed = outlines.join(aligned, ["host", "skeleton"]).select(
        "host",
        "digest",
        F.expr("transform(arrays_zip(slots, hashes, sizes), s -> (nodes[s.slots] AS node, s.hashes AS hash, s.sizes AS size))").alias("texts"),
    )
    candidates = templates.mapInPandas(_candidates, "host string, candidates array<int>")
    main = (
        placed.select("host", F.inline("texts"))
        .groupBy("host", "node", "hash")
        .agg(F.sum("size").alias("size"))
        .groupBy("host", "node")
        .agg((F.sum("size") * F.log2(F.count("*") + F.lit(1))).alias("size"))
        .join(candidates, "host")
        .where(F.array_contains("candidates", F.col("node")))
        .groupBy("host")
        .agg(F.max(F.struct("size", (-F.col("node")).alias("first"))).alias("m"))
        .select("host", (-F.col("m.first")).alias("main"))
    )
    main = stored(main)
    context = F.expr("coalesce(get(filter(texts, t -> t.node = main), 0).hash, digest)")
    fills = (
        placed.join(main, "host", "left")
        .select("host", "main", context.alias("context"), F.inline("texts"))
        .select("host", "main", "context", "node", "hash")
        .distinct()
        .groupBy("host", "main", "node", "hash")
        .agg(F.count("*").alias("n"))
        .groupBy("host", "main", "node")
        .agg(F.sum("n").alias("pages"), F.count("*").alias("texts"), F.max("n").alias("most"))
    )
    framed = F.col("main").isNull() | (F.col("node") != F.col("main"))
    same = (F.col("pages") >= CONSTANT_PAGES) & (F.col("most") >= CONSTANT_SHARE * F.col("pages"))
    few = (F.col("pages") >= VARIANT_PAGES) & (F.col("texts") <= VARIANT_SHARE * F.col("pages"))
    slots = fills.where("node >= 0").groupBy("host").agg(
        F.collect_set(F.when(framed & (same | few), F.col("node"))).alias("constant"), F.collect_set("node").alias("filled")
    )
    return aligned.join(slots, "host", "left").mapInPandas(_decided, "host string, skeleton string, keep array<boolean>")


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    ``text`` is the article's blocks, one per line; empty for a NULL or empty page
    and for one without an article.  Pages without URL form one host.  Repeated rows each
    get their row; other columns are ignored.
    """
    narrow = pages.select("page_id", "url", "html")
    wrappers = stored(induce(narrow))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, page in zip(batch["url"], batch["html"]):  # noqa: B905
                root, found = dom.parse(page or "")
                rows.append((host_of(url), dom.write(root), [n for n, _ in found], [t for _, t in found]))
            out = pd.DataFrame(rows, columns=["host", "skeleton", "slots", "texts"], index=batch.index)
            yield pd.concat([batch[["page_id", "url"]], out], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    parsed = narrow.mapInPandas(
        blocks,
        f"page_id {kinds['page_id']}, url string, host string, skeleton string, slots array<int>, texts array<string>",
    )
    size = wrappers.agg(F.sum(F.length("skeleton") + F.size("keep"))).first()[0] or 0
    if size <= BROADCAST_CHARS and small(wrappers, BROADCAST_ROWS):
        wrappers = F.broadcast(wrappers)
    text = F.expr("array_join(filter(texts, (t, k) -> keep[slots[k]]), '\\n')")
    joined = parsed.join(wrappers, ["host", "skeleton"], "left").select("page_id", "url", F.coalesce(text, F.lit("")).alias("text"))
    return joined.withColumn("n_chars", F.char_length("text").cast("long"))
