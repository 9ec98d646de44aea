"""Documents to technology clusters: embedding, plane, density, terms, labels, freezing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cluster_name
from ..functions.udfs import embedding
from ..session import materialise
from .relational import first_per_key, signature

VECTOR, MOST_TOKENS = 384, 256
LEAST_CLUSTER, LEAST_NEIGHBOURS = 50, 50
TERMS, FEATURES = 15, 10_000
NOISE = "c_noise"
MOST_TITLES = 5
# Labels of noise and of clusters whose answer can't be read; the cluster's id follows.
NOISE_TAGLINE = "Frontier / Unclustered"
FALLBACK_TAGLINE = "Technology Cluster "
FALLBACK_SUMMARY = "A technology cluster identified from microchip hardware patent and paper data. Cluster identifier: "
#: English stop words, written for this repository.
STOP_WORDS = (
    "a about above after again against all almost alone along already also although always am among an and another any are around as at be became because been before being below between both but by can cannot could did do does doing done down during each either else enough etc even ever every few first for from further get give had has have having he her here hers herself him himself his how however i if in indeed into is it its itself last least less made many may me might mine more moreover most mostly much must my myself namely neither never nevertheless next no nobody none nor not nothing now of off often on once one only onto or other others otherwise our ours ourselves out over own part per perhaps please put rather re same see seem seemed seems several she should since so some somehow still such than that the their them themselves then thence there thereby therefore therein these they this those though through throughout thru thus to together too toward towards under until up upon us very via was we well were what whatever when whence whenever where whereas whereby wherein whether which while who whole whom whose why will with within without would yet you your yours yourself yourselves"
).split()


def embedded(corpus: DataFrame, encoder: Callable[[Column], Column] = embedding, most_tokens: int = MOST_TOKENS, tokens: Callable[[Column], Column] | None = None) -> DataFrame:
    """The corpus with a unit vector a document and whether its text passes the encoder's length in tokens."""
    tokens = tokens or word_pieces
    # a scan may be one task, however many texts it has
    return corpus.hint("rebalance").select("*", encoder(F.col("text")).alias("embedding"), (tokens(F.col("text")) > most_tokens).alias("truncated"))


def word_pieces(text: Column) -> Column:
    """Tokens of a text, about as a sub-word tokenizer counts them: marks, pieces of six characters, and the two special ones."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{M}\p{N}]{1,6}|[^\s\p{L}\p{M}\p{N}]")) + 2


def encoded(corpus: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], text: str = "text", batch: int = 64) -> DataFrame:
    """The corpus with a vector a document by a model: ``load`` is called once a task and gives a function of up to ``batch`` texts."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in corpus.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            texts = [t or "" for t in frame[text]]
            vectors = [v for at in range(0, len(texts), batch) for v in np.asarray(model(texts[at : at + batch]), dtype=np.float32)]
            yield frame.assign(embedding=pd.Series(vectors, index=frame.index, dtype=object))

    return corpus.mapInPandas(run, f"{kinds}, embedding array<float>")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def centroids(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """(group, centroid): means by place, summed vector by vector map-side."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    each = vectors.where(F.col(vector).isNotNull()).select(group, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("v"))
    return each.groupBy(group).agg(Summarizer.mean(F.col("v")).alias("m")).select(group, vector_to_array("m").alias("centroid"))


def plane(vectors: DataFrame, id_col: str, vector: str = "embedding") -> DataFrame:
    """(id, umap_x, umap_y): the first two principal components of the unit vectors, signs fixed.

    A stand-in for a neighbour-graph projection, which gives another picture each run; this one is the same each time.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = vectors.select(F.col(id_col), array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("v"))
    model = PCA(k=2, inputCol="v", outputCol="p").fit(v)
    pc = model.pc.toArray()
    sign = [1.0 if col[abs(col).argmax()] >= 0 else -1.0 for col in pc.T]
    p = model.transform(v).select(id_col, vector_to_array("p").alias("p"))
    return p.select(id_col, (F.col("p")[0] * sign[0]).cast("float").alias("umap_x"), (F.col("p")[1] * sign[1]).cast("float").alias("umap_y"))


def dense_clusters(points: DataFrame, id_col: str, radius: float, least: int = LEAST_NEIGHBOURS, smallest: int = LEAST_CLUSTER, x: str = "umap_x", y: str = "umap_y") -> DataFrame:
    """(id, label): density clusters of points in the plane by a grid; -1 is noise.

    The plane is cut into cells of side ``radius``. A cell's density is the points in it and its eight neighbours; cells
    that reach ``least`` are core, and core cells that touch are one cluster, as are the points of cells beside them. All after the
    first count is over occupied cells, never over pairs of points. Labels are numbered by size, then least id.
    """
    cell = points.select(id_col, F.floor(F.col(x).cast("double") / radius).alias("cx"), F.floor(F.col(y).cast("double") / radius).alias("cy"))
    cells = cell.groupBy("cx", "cy").agg(F.count("*").alias("n"))
    steps = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    spread = cells.select("n", F.col("cx").alias("fx"), F.col("cy").alias("fy"), F.inline(steps)).select("n", "fx", "fy", (F.col("fx") + F.col("dx")).alias("cx"), (F.col("fy") + F.col("dy")).alias("cy"))
    density = spread.join(cells.select("cx", "cy"), ["cx", "cy"], "left_semi").groupBy("cx", "cy").agg(F.sum("n").alias("d"))
    core = materialise(density.where(F.col("d") >= least).select("cx", "cy", F.struct("cx", "cy").alias("root")))
    while True:
        near = core.select("root", "cx", "cy", F.inline(steps)).select("root", (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"))
        least_root = near.groupBy("cx", "cy").agg(F.min("root").alias("least"))
        step = core.join(least_root, ["cx", "cy"]).select("cx", "cy", "root", "least")
        jump = step.select(F.col("cx").alias("rx"), F.col("cy").alias("ry"), F.col("least").alias("further"))
        moved = materialise(step.join(jump, (F.col("least.cx") == F.col("rx")) & (F.col("least.cy") == F.col("ry"))).select("cx", "cy", F.least("least", "further").alias("root"), F.col("root").alias("was")))
        core = moved.select("cx", "cy", "root")
        if moved.where("root <> was").isEmpty():
            break
    edge = core.select("root", "cx", "cy", F.inline(steps)).select("root", (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"))
    owner = core.select("cx", "cy", F.col("root"), F.lit(0).alias("far")).unionByName(edge.select("cx", "cy", "root", F.lit(1).alias("far"))).groupBy("cx", "cy").agg(F.min(F.struct("far", "root")).alias("o")).select("cx", "cy", F.col("o.root").alias("root"))
    members = cell.join(owner, ["cx", "cy"], "left")
    sizes = members.where("root is not null").groupBy("root").agg(F.count("*").alias("n"), F.min(id_col).alias("first")).where(F.col("n") >= smallest)
    # one row a cluster
    numbered = sizes.withColumn("label", F.row_number().over(Window.orderBy(F.col("n").desc(), "first")) - 1).select("root", "label")
    return members.join(numbered, "root", "left").select(id_col, F.coalesce("label", F.lit(-1)).alias("label"))


def terms(docs: DataFrame, label: str = "label", text: str = "text", most: int = TERMS, features: int = FEATURES, stop_words=STOP_WORDS) -> DataFrame:
    """(label, term, weight, rank): distinctive words and word pairs of each class by class-based TF-IDF.

    A class is all its documents; rows of a negative label are left out. tf is a term's share of the class's counted terms,
    idf is ln(classes / classes with the term); only the ``features`` most frequent terms are counted. Ties go by term. A pair
    spans no two documents.
    """
    docs = docs.select(F.col(label).alias("label"), F.col(text).alias("text"))
    kept = docs.where((F.col("label") >= 0) & (F.coalesce(F.col("text"), F.lit("")) != ""))
    words = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\b\w\w+\b"), F.lit(0)), lambda w: ~w.isin(*stop_words))
    pairs = F.when(F.size("w") > 1, F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    # a scan may be one task, however many texts it has
    each = kept.hint("rebalance").select("label", words.alias("w")).select("label", F.explode(F.concat("w", pairs)).alias("term"))
    counts = materialise(each.groupBy("label", "term").agg(F.count("*").alias("n")))  # read three times
    chosen = counts.groupBy("term").agg(F.sum("n").alias("total"), F.count("*").alias("df")).orderBy(F.col("total").desc(), "term").limit(features).select("term", "df")
    known = counts.join(F.broadcast(chosen), "term")  # ``features`` rows
    classes = kept.select(F.countDistinct("label").alias("classes"))
    sums = known.groupBy("label").agg(F.sum("n").alias("all"))
    weight = F.col("n") / (F.col("all") + F.lit(1e-9)) * F.log(F.col("classes") / (F.col("df") + F.lit(1e-9)))
    scored = known.join(sums, "label").crossJoin(F.broadcast(classes)).select("label", "term", weight.alias("weight"))  # one row
    order = [F.round("weight", 12).desc(), F.col("term")]
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(*order))).where(F.col("rank") <= most)


def cluster_terms(docs: DataFrame, **options) -> DataFrame:
    """(cluster_id, top_terms) of every cluster, noise with none."""
    found = terms(docs, **options).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias("top_terms"))
    named = found.select(cluster_name(F.col("label")).alias("cluster_id"), "top_terms")
    noise = docs.sparkSession.createDataFrame([(NOISE, [])], "cluster_id string, top_terms array<string>")
    return named.unionByName(noise)


def cluster_documents(docs: DataFrame, labels: DataFrame, coordinates: DataFrame, version: str) -> DataFrame:
    out = docs.select("doc_id", "doc_type").join(labels, "doc_id").join(coordinates, "doc_id")
    return out.select("doc_id", "doc_type", cluster_name(F.col("label")).alias("cluster_id"), "umap_x", "umap_y", F.lit(version).alias("model_version"))


def still_valid(docs: DataFrame, frozen: DataFrame) -> bool:
    """Whether a clustering was made of these very documents; then it is kept as it is."""
    return signature(docs, "doc_id").first() == signature(frozen, "doc_id").first()


def prompt(cluster_id: Column, top_terms: Column, titles: Column) -> Column:
    """Request for a label, for a hosted model: the cluster, its first terms and titles, and nothing else to name it by."""
    listed = F.transform(F.slice(titles, 1, MOST_TITLES), lambda t: F.concat(F.lit("- "), t))
    return F.concat_ws(
        "\n", F.concat(F.lit("Cluster "), cluster_id), F.concat(F.lit("Terms: "), F.array_join(F.slice(top_terms, 1, TERMS), ", ")), F.lit("Titles:"), F.array_join(listed, "\n"),
        F.lit('Name and describe the cluster by these alone. Answer as JSON: {"tagline": "...", "summary_friendly": "..."}'),
    )


def parsed_label(answer: Column, cluster_id: Column) -> Column:
    """struct(tagline, summary_friendly) from an answer, JSON with anything around it; where it can't be read, or lacks one, the cluster's id."""
    inside = F.regexp_extract(answer, r"(?s)\{.*\}", 0)
    read = F.from_json(inside, "tagline string, summary_friendly string")
    both = F.coalesce((F.trim(read["tagline"]) != "") & (F.trim(read["summary_friendly"]) != ""), F.lit(False))
    fallback = F.concat(F.lit(FALLBACK_SUMMARY), cluster_id, F.lit("."))
    return F.struct(F.when(both, F.trim(read["tagline"])).otherwise(F.concat(F.lit(FALLBACK_TAGLINE), cluster_id)).alias("tagline"), F.when(both, F.trim(read["summary_friendly"])).otherwise(fallback).alias("summary_friendly"))


def label_of_terms(top_terms: Column) -> Column:
    """struct(tagline, summary_friendly) from the terms, where no model is at hand."""
    named = F.coalesce(F.nullif(F.initcap(F.array_join(F.slice(top_terms, 1, 3), " / ")), F.lit("")), F.lit("Unlabelled cluster"))
    return F.struct(named.alias("tagline"), F.concat(F.lit("Documents about "), F.array_join(F.slice(top_terms, 1, 5), ", "), F.lit(".")).alias("summary_friendly"))


def labelled(terms_: DataFrame, examples: DataFrame | None = None, answer: Callable[[Column], Column] | None = None, most_titles: int = MOST_TITLES) -> DataFrame:
    """(cluster_id, tagline, summary_friendly, top_terms): by a given model, else from the terms; noise has a fixed label."""
    out = terms_
    if examples is not None:
        some = first_per_key(examples, "cluster_id", [F.col("doc_id")], most_titles).groupBy("cluster_id").agg(F.sort_array(F.collect_list("title")).alias("titles"))
        out = out.join(some, "cluster_id", "left")
    else:
        out = out.withColumn("titles", F.array().cast("array<string>"))
    asked = prompt(F.col("cluster_id"), F.col("top_terms"), F.coalesce("titles", F.array().cast("array<string>")))
    named = parsed_label(answer(asked), F.col("cluster_id")) if answer else label_of_terms(F.col("top_terms"))
    label = F.when(F.col("cluster_id") == NOISE, F.struct(F.lit(NOISE_TAGLINE).alias("tagline"), F.lit("Documents that form no distinct cluster.").alias("summary_friendly"))).otherwise(named)
    return out.withColumn("l", label).select("cluster_id", "l.tagline", "l.summary_friendly", "top_terms")
