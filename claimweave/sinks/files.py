"""Datasets, audit lines and reports as files, written by the executors wherever they grow with the data."""

from __future__ import annotations

import html
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.geometry import format_points, label_line

AUDIT_FIELDS = ("claim_id", "id_evaluacion", "input_hashes", "model_version", "output_summary", "processing_time_ms", "rule_id_applied", "timestamp")


def label_lines(images: DataFrame, shapes: DataFrame, class_id: str = "class_id", polygon: str = "polygon") -> DataFrame:
    """(id, split, stem, lines): one row an image, the lines of its shapes in order, empty for images without any."""
    lines = shapes.groupBy("image_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", label_line(F.col(class_id), F.col(polygon)).alias("l")))), lambda x: x["l"]).alias("lines"))
    return images.join(lines, images["id"] == lines["image_id"], "left").select("id", "split", F.regexp_extract("file_name", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"), F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))


def write_labels(rows: DataFrame, path: str) -> None:
    """Label lines by split: labels/split=<split>/ with one JSON row an image."""
    rows.write.mode("overwrite").partitionBy("split").json(f"{path}/labels")


def write_label_files(rows: DataFrame, path: str) -> int:
    """<path>/<split>/<stem>.txt, one file an image, by the tasks on a shared file system; returns their number."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            for split, stem, lines in zip(batch["split"], batch["stem"], batch["lines"], strict=True):
                target = Path(path) / str(split) / f"{stem}.txt"
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text("".join(f"{line}\n" for line in lines))
            yield pd.DataFrame({"n": [len(batch)]})

    return rows.select("split", "stem", "lines").mapInPandas(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def dataset_yaml(path: str, classes: tuple[str, ...]) -> str:
    """Text of the dataset description."""
    return f"path: {path}\ntrain: images/train\nval: images/val\ntest: images/test\nnames:\n" + "".join(f"  {i}: {c}\n" for i, c in enumerate(classes))


def write_coco_tables(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """The dataset as three Parquet tables."""
    for name, df in (("images", images), ("annotations", annotations), ("categories", categories)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def coco_document(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """One row with the dataset as a single JSON document.  For exports of bounded size: the document is one value."""
    part = lambda df, name: df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
    document = F.struct(*[part(df, n).scalar().alias(n) for n, df in (("images", images), ("annotations", annotations), ("categories", categories))])
    return images.sparkSession.range(1).select(F.to_json(document).alias("value"))


def copy_manifest(images: DataFrame, sources: DataFrame, target: str) -> DataFrame:
    """(id, src, dst) of image files to bring into a dataset; the last source of a name wins, names without one are left out."""
    from claimweave.operators.lookup import last_source_wins

    found = last_source_wins(sources, "file_name", "source_order").select("file_name", F.col("path").alias("src"))
    return images.join(found, "file_name").select("id", "src", F.concat(F.lit(f"{target}/"), "split", F.lit("/"), "file_name").alias("dst"))


def cvat_images(images: DataFrame, shapes: DataFrame) -> DataFrame:
    """One ``<image>`` element an image, in review order: only its first shape, points with one decimal, the score with three.

    ``review_order`` of the images becomes the element's id.
    """
    first = shapes.groupBy("image_id").agg(F.min_by(F.struct("label", "polygon", "confidence"), "ordinal").alias("s"))
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("unknown")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    shape = F.concat(F.lit('<polygon label="'), esc(F.col("s.label")), F.lit('" points="'), format_points(F.col("s.polygon")), F.lit('"><attribute name="confidence">'), F.format_string("%.3f", F.coalesce("s.confidence", F.lit(0.0))), F.lit("</attribute></polygon>"))
    element = F.concat(F.lit('<image id="'), F.col("review_order").cast("string"), F.lit('" name="'), esc(F.col("file_name")), F.lit('" width="'), F.col("width").cast("string"), F.lit('" height="'), F.col("height").cast("string"), F.lit('">'), F.when(F.col("s").isNotNull(), shape).otherwise(F.lit("")), F.lit("</image>"))
    return images.join(first, images["id"] == first["image_id"], "left").select("review_order", element.alias("element"))


def write_cvat(elements: DataFrame, path: str) -> None:
    """annotations.xml of a review package (a person reviews it, so its size is bounded by that)."""
    body = "\n".join(r["element"] for r in elements.orderBy("review_order").toLocalIterator())
    Path(path).write_text(f'<?xml version="1.0" encoding="utf-8"?>\n<annotations>\n<version>1.1</version>\n{body}\n</annotations>\n')


def write_cvat_parts(images: DataFrame, shapes: DataFrame, path: str) -> None:
    """A folder of XML files, each complete, written by the tasks: for exports of any size."""
    first = shapes.groupBy("image_id").agg(F.min_by(F.struct("label", "polygon", "confidence"), "ordinal").alias("s"))
    score = F.struct(F.lit("confidence").alias("_name"), F.format_string("%.3f", F.coalesce("s.confidence", F.lit(0.0))).alias("_VALUE"))
    shape = F.struct(F.coalesce("s.label", F.lit("unknown")).alias("_label"), format_points(F.col("s.polygon")).alias("_points"), score.alias("attribute"))
    rows = images.join(first, images["id"] == first["image_id"], "left").select(
        F.col("review_order").alias("_id"), F.col("file_name").alias("_name"), F.col("width").alias("_width"), F.col("height").alias("_height"), F.when(F.col("s").isNotNull(), F.array(shape)).alias("polygon")
    )
    rows.write.mode("overwrite").format("xml").option("rootTag", "annotations").option("rowTag", "image").save(path)


def write_documents(documents: DataFrame, path: str, value: str = "value") -> None:
    """One JSON document a line, as text."""
    documents.select(F.col(value).alias("value")).write.mode("overwrite").text(path)


def output_document(claims: DataFrame, assembled: DataFrame) -> DataFrame:
    """(claim_id, value): the evaluation of a claim as one JSON document, a claim without damages with an empty list.

    ``claims`` has claim_id, id_evaluacion, timestamp, model_version, input_hashes and processing_time_ms;
    ``assembled`` comes from :func:`claimweave.operators.consolidate.assemble_claims`.
    """
    joined = claims.join(assembled, "claim_id", "left")
    damages = F.coalesce("damages", F.array().cast(dict(assembled.dtypes)["damages"]))
    zones = F.coalesce("zones_summary", F.create_map().cast(dict(assembled.dtypes)["zones_summary"]))
    audit = F.struct("input_hashes", "processing_time_ms")
    return joined.select("claim_id", F.to_json(F.struct("id_evaluacion", F.col("claim_id").cast("string").alias("claim_id"), "timestamp", "model_version", damages.alias("damages"), zones.alias("zones_summary"), audit.alias("audit"))).alias("value"))


def zip_package(xml: str, files: list[str], target: str) -> None:
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        z.write(xml, "annotations.xml")
        for f in files:
            z.write(f, f"data/{Path(f).name}")


def date_token(timestamp: Column) -> Column:
    """YYYYMMDD of the first ten characters of an ISO time; null where they are no date."""
    head = F.substring(timestamp, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.replace(head, F.lit("-"), F.lit("")))


def audit_records(outputs: DataFrame) -> DataFrame:
    """One record an evaluation with the audit's fields and no others, as (date, line): keys sorted, day for rotation."""
    fields = [F.col(c) for c in sorted(AUDIT_FIELDS)]
    day = F.coalesce(date_token(F.col("timestamp").cast("string")), F.lit("undated"))
    return outputs.select(day.alias("date"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"))


def append_audit(records: DataFrame, path: str) -> None:
    """Append lines to the folder of their day."""
    records.withColumnRenamed("line", "value").write.mode("append").partitionBy("date").text(path)


def _rows_html(df: DataFrame, limit: int) -> str:
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in df.limit(limit).collect())
    return f"<table border='1'><tr>{head}</tr>{body}</table>"


def html_page(title: str, parts: list[tuple[str, DataFrame]], limit: int = 200) -> str:
    """A self-contained page with the first rows of some results under headings; ``limit`` is what a page shows of each."""
    inside = "".join(f"<h2>{html.escape(name)}</h2>{_rows_html(df, limit)}" for name, df in parts)
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{inside}</body></html>"


def html_table(df: DataFrame, title: str, limit: int = 200) -> str:
    return html_page(title, [("", df)], limit)


def metrics_page(headline: DataFrame, brackets: DataFrame, targets: DataFrame, intervals: DataFrame) -> str:
    """Metrics of a golden set: headline figures, error per bracket, targets, intervals."""
    return html_page("Metrics", [("Headline", headline), ("Error per bracket", brackets), ("Targets", targets), ("Intervals", intervals)])


def appraisal_page(claim: DataFrame, damages: DataFrame) -> str:
    """One claim and its damages, all of them."""
    return html_page("Appraisal", [("Claim", claim), ("Damages", damages)], damages.count() + 1)


def review_page(images: DataFrame, score: str, shown: int = 200) -> str:
    """The images to be looked at first: least certain ones first, a page of them, each with a mark for its certainty."""
    c = F.col(score)
    ranked = images.withColumn("certainty", F.when(c >= 0.5, "high").when(c >= 0.3, "medium").otherwise("low")).orderBy(score, *[x for x in images.columns if x != score])
    return html_page("Review", [("Least certain images", ranked)], shown)


def spot_check_page(sample: DataFrame, label: str) -> str:
    """A sample of each class side by side; the sample is bounded by what was drawn per class."""
    names = [r[0] for r in sample.select(label).distinct().orderBy(label).collect()]
    return html_page("Spot check", [(str(n), sample.where(F.col(label) == n)) for n in names], sample.count() + 1)


_OUTPUT = (
    "id_evaluacion string, claim_id string, timestamp string, model_version string, lane string, lane_rule_id string, "
    "damages array<struct<damage_id string>>, estimacion struct<total_eur double>, audit struct<input_hashes array<string>, processing_time_ms bigint>"
)


def audit_from_outputs(outputs: DataFrame, payload: str, *beside: str) -> DataFrame:
    """Audit fields of evaluation documents, every missing one with its default; nothing else is carried over but the columns ``beside`` the document."""
    o = outputs.select(F.from_json(payload, _OUTPUT).alias("o"), *beside).select("o.*", *beside)
    return o.select(
        F.coalesce("claim_id", F.lit("")).alias("claim_id"), F.coalesce("id_evaluacion", F.lit("")).alias("id_evaluacion"), F.coalesce("audit.input_hashes", F.array().cast("array<string>")).alias("input_hashes"), F.coalesce("model_version", F.lit("")).alias("model_version"),
        F.struct(F.coalesce("lane", F.lit("")).alias("lane"), F.greatest(F.size("damages"), F.lit(0)).alias("n_damages"), F.coalesce("estimacion.total_eur", F.lit(0.0)).alias("total_eur")).alias("output_summary"),
        F.coalesce("audit.processing_time_ms", F.lit(0)).alias("processing_time_ms"), F.coalesce("lane_rule_id", F.lit("")).alias("rule_id_applied"), F.coalesce("timestamp", F.lit("")).alias("timestamp"), *beside,
    )


def leakage_audit(assigned: DataFrame, strategy: str, seed: int, ratios: dict[str, float]) -> DataFrame:
    """One row with the audit of a split (id, group_id, split) as JSON: counts, ratios asked for, groups that cross."""
    crossing = assigned.groupBy("group_id").agg(F.countDistinct("split").alias("n")).where("n > 1").agg(F.count(F.lit(1))).scalar()
    splits = F.struct(*[F.count_if(F.col("split") == s).alias(s) for s in ratios])
    counts = assigned.agg(F.count(F.lit(1)).alias("n_images"), F.countDistinct("group_id").alias("n_groups"), splits.alias("splits"))
    asked = F.struct(*[F.lit(r).alias(s) for s, r in ratios.items()])
    return counts.select(F.to_json(F.struct(F.lit(strategy).alias("strategy"), F.lit(seed).alias("seed"), "n_images", "n_groups", asked.alias("ratios_requested"), "splits", crossing.alias("cross_split_groups"))).alias("value"))
