"""Queries S7-S10 over an image tree rendered from ``embeddings``
(one 8x8 gray PNG per row, in a folder named by its label)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ...session import scratch_path
from ...sources import images as IM
from ..tables import table


def image_tree(spark, sf) -> str:
    root = scratch_path(spark, f"images/{uuid.uuid4().hex}")
    IM.write_embedding_images(table(spark, sf, "embeddings"), root).write.format("noop").mode("overwrite").save()
    return root


def q_image_manifest_dir(spark, sf):
    root = image_tree(spark, sf)
    m = IM.image_manifest_dir(spark, root)
    return m.select(IM.relative_path(spark, F.col("image_path"), root).alias("rel_path"), "label")


def _csv_manifest(spark, sf, root, missing_twins=False):
    e = table(spark, sf, "embeddings")
    name = F.concat(F.col("label").cast("string"), F.lit("/"), F.format_string("%06d", F.col("vec_id")),
                    F.lit(".png"))
    rows = e.select(F.concat(F.lit(root + "/"), name).alias("file"), F.col("label").cast("string").alias("class"))
    if missing_twins:  # one listed-but-absent file per row
        rows = rows.unionByName(e.select(
            F.concat(F.lit(root + "/missing/"), F.format_string("%06d", F.col("vec_id")), F.lit(".png")).alias("file"),
            F.col("label").cast("string").alias("class")))
    path = scratch_path(spark, f"manifests/{uuid.uuid4().hex}")
    rows.write.option("header", "true").csv(path)
    return IM.image_manifest_csv(spark, path, image_column="file", target_column="class")


def q_image_manifest_csv(spark, sf):
    root = image_tree(spark, sf)
    m = _csv_manifest(spark, sf, root)
    return m.select(IM.relative_path(spark, F.col("image_path"), root).alias("rel_path"), "label")


def q_manifest_missing_files(spark, sf):
    root = image_tree(spark, sf)
    m = _csv_manifest(spark, sf, root, missing_twins=True)
    miss = IM.manifest_missing_files(spark, m, root)
    return miss.select(IM.relative_path(spark, F.col("image_path"), root).alias("rel_path"), "label")


def q_image_decode_resize(spark, sf):
    root = image_tree(spark, sf)
    d = IM.image_decode_resize(spark, root, 8, 8, manifest=IM.image_manifest_dir(spark, root))
    n = 8 * 8 * 3
    px = F.transform(F.sequence(F.lit(1), F.lit(n)),
                     lambda i: F.conv(F.hex(F.substring("data", i, 1)), 16, 10).cast("bigint"))
    return d.select(IM.relative_path(spark, F.col("image_path"), root).alias("rel_path"), "label", "height",
                    "width", "n_channels", "decoded",
                    F.aggregate(px, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("pixel_sum"))


def q_image_resize_mixed(spark, sf):
    """S10 down-scaled to a non-square size, over gray, colour and undecodable files: one row a pixel and channel."""
    root = scratch_path(spark, f"images/{uuid.uuid4().hex}")
    e = table(spark, sf, "embeddings")
    IM.write_embedding_images(e, root, mixed=True).write.format("noop").mode("overwrite").save()
    d = IM.image_decode_resize(spark, root, 3, 5, manifest=IM.image_manifest_dir(spark, root))
    px = F.transform(F.sequence(F.lit(1), F.lit(3 * 5 * 3)), lambda i: F.conv(F.hex(F.substring("data", i, 1)), 16, 10).cast("bigint"))
    flat = d.select(IM.relative_path(spark, F.col("image_path"), root).alias("rel_path"), "height", "width", "decoded", F.posexplode(px).alias("at", "value"))
    at = F.col("at")
    return flat.select("rel_path", "height", "width", "decoded", F.floor(at / 15).alias("y"), (F.floor(at / 3) % 5).alias("x"), (at % 3).alias("channel"), "value")


def q_image_dataset_summary(spark, sf):
    from ...operators import profile as P
    root = image_tree(spark, sf)
    m = IM.image_manifest_dir(spark, root)
    info = P.image_dataset_info(m, "directory", (8, 8), "embeddings-images")
    return P.image_dataset_summary(info, P.class_distribution(m, "label"))


QUERIES = {
    "image_dataset_summary": q_image_dataset_summary,
    "image_manifest_dir": q_image_manifest_dir,
    "image_manifest_csv": q_image_manifest_csv,
    "manifest_missing_files": q_manifest_missing_files,
    "image_decode_resize": q_image_decode_resize,
    "image_resize_mixed": q_image_resize_mixed,
}

_REL = "cast(label as varchar) || '/' || printf('%06d', vec_id) || '.png'"
SQL = {
    "image_dataset_summary": """with c as (select cast(label as varchar) label, count(*) n from embeddings group by label),
r as (select label, n, n * 100.0 / sum(n) over () pct, row_number() over (order by n desc, label) rk from c),
h as (select count(*) n, count(distinct label) k from embeddings),
head as (select unnest([repeat('=', 60), 'IMAGE DATASET SUMMARY', repeat('=', 60), 'Source: embeddings-images',
      'Structure: directory', 'Images: ' || format('{:,}', n), 'Image Size: 8x8', '', 'Task: SUPERVISED',
      'Classes: ' || k, '', 'Class Distribution:']) line, unnest(range(1, 13)) line_no from h)
select cast(line_no as bigint) line_no, line from head
union all select cast(12 + rk as bigint), '  ' || label || ': ' || n || ' (' || printf('%.1f', pct) || '%)' from r
union all select cast(13 + (select count(*) from c) as bigint), repeat('=', 60)""",
    "image_manifest_dir": f"select {_REL} rel_path, cast(label as varchar) label from embeddings",
    "image_manifest_csv": f"select {_REL} rel_path, cast(label as varchar) label from embeddings",
    "manifest_missing_files": """select 'missing/' || printf('%06d', vec_id) || '.png' rel_path,
  cast(label as varchar) label from embeddings""",
    "image_decode_resize": f"""select {_REL} rel_path, cast(label as varchar) label, 8 height, 8 width, 3 n_channels,
  1 decoded, cast(3 * (select sum(least(greatest(floor((cast(v as double) + 1.0) * 127.5 + 0.5), 0), 255))
                       from unnest(embedding) t(v)) as bigint) pixel_sum from embeddings""",
}
# triangle filter over every input pixel, widened by the scale; columns first, each step rounded
SQL["image_resize_mixed"] = f"""with e as (select vec_id, {_REL} rel_path, embedding, vec_id % 3 = 0 as colour, vec_id % 7 = 0 as cut,
    case when vec_id % 3 = 0 then 4 else 8 end as h from embeddings),
g as (select vec_id, i // 8 as y, i % 8 as x, least(greatest(floor((cast(embedding[i + 1] as double) + 1.0) * 127.5 + 0.5), 0), 255) as v
      from e, range(0, 64) t(i) where i // 8 < h and not cut),
p as (select vec_id, y, x, c as channel, case when not colour then v when c = 0 then v when c = 1 then 255 - v else 0 end as v
      from g join e using (vec_id), range(0, 3) t(c)),
wx as (select o, i, greatest(0, 1 - abs(i + 0.5e0 - (o + 0.5e0) * 1.6e0) / 1.6e0) as w from range(0, 5) a(o), range(0, 8) b(i)),
nx as (select o, i, w / sum(w) over (partition by o) as w from wx),
a as (select vec_id, y, o as x, channel, floor(round(sum(v * w), 9) + 0.5e0) as v from p join nx on p.x = nx.i group by all),
wy as (select h, o, i, greatest(0, 1 - abs(i + 0.5e0 - (o + 0.5e0) * h / 3.0e0) / (h / 3.0e0)) as w
       from (values (4), (8)) s(h), range(0, 3) q(o), range(0, 8) b(i) where i < h),
ny as (select h, o, i, w / sum(w) over (partition by h, o) as w from wy),
r as (select vec_id, o as y, x, channel, least(greatest(floor(round(sum(v * w), 9) + 0.5e0), 0), 255) as v
      from a join e using (vec_id) join ny on e.h = ny.h and a.y = ny.i group by all)
select rel_path, 3 height, 5 width, case when cut then 0 else 1 end decoded, yy as y, xx as x, cc as channel, cast(coalesce(r.v, 0) as bigint) as value
from e, range(0, 3) q(yy), range(0, 5) s(xx), range(0, 3) t(cc)
left join r on r.vec_id = e.vec_id and r.y = yy and r.x = xx and r.channel = cc"""
