"""Queries on colours, boxes and stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import colour
from ..functions.geometry import box_iou
from ..functions.numeric import rounded
from ..operators import pages
from . import standins as si
from .registry import query
from .tables import Tables

# The checking SQL works on lists of channels, from the definitions of sRGB and CIE LAB.
LAB_SQL = f"""
    , tri as (select id, "R", "G", "B", list_transform({[list(row) for row in colour.RGB_TO_XYZ]}::double[][], lambda row: list_inner_product(row,
                  list_transform(["R", "G", "B"], lambda v: if(v <= {255 * colour.SRGB_CUT}, v / {255 * colour.SRGB_SLOPE},
                      pow((v / 255.0::double + {colour.SRGB_OFFSET}) / {colour.SRGB_SCALE}, {colour.SRGB_GAMMA}))))) as tri from colours),
    lab as (select id, "R", "G", "B", list_transform(list_zip(tri, {list(colour.WHITE)}::double[]), lambda p: if(p[1] / p[2] <= {colour.LAB_CUT},
                  p[1] / p[2] * {colour.LAB_SLOPE} + {colour.LAB_OFFSET}, pow(p[1] / p[2], 1 / 3.0::double))) as t from tri)"""


@query("rgb_to_lab", LAB_SQL + """
    select id, "R", "G", "B", round(t[2] * 116 - 16, 6) + 0.0 as "labL", round((t[1] - t[2]) * 500, 6) + 0.0 as "labA",
           round((t[2] - t[3]) * 200, 6) + 0.0 as "labB" from lab""", ("colours",))
def rgb_to_lab(t: Tables) -> DataFrame:
    lab = colour.rgb_to_lab(si.colours(t), keep=("id",))
    return lab.withColumns({c: rounded(F.col(c)) for c in ("labL", "labA", "labB")})


# Hue by the angle formula on whole channels: 60 degrees a sector, counted from the largest channel.
@query("rgb_to_hsv", """
    select id, "R", "G", "B",
           round(coalesce(((case greatest("R", "G", "B") when "B" then 240 + 60 * ("R" - "G") / 255.0::double / nullif(top - low, 0)
                                                         when "G" then 120 + 60 * ("B" - "R") / 255.0::double / nullif(top - low, 0)
                                                         else 360 + 60 * ("G" - "B") / 255.0::double / nullif(top - low, 0) end) % 360) / 360, 0), 6) as "H",
           round(coalesce((top - low) / nullif(top, 0), 0), 6) as "S", round(top, 6) as "V"
    from (select *, greatest("R", "G", "B") / 255.0::double as top, least("R", "G", "B") / 255.0::double as low from colours)""", ("colours",))
def rgb_to_hsv(t: Tables) -> DataFrame:
    hsv = colour.rgb_to_hsv(si.colours(t), keep=("id",))
    return hsv.withColumns({c: rounded(F.col(c)) for c in "HSV"})


@query("lab_to_rgb", """
    select id, "R"::double as "R", "G"::double as "G", "B"::double as "B" from colours""", ("colours",))
def lab_to_rgb(t: Tables) -> DataFrame:
    """There and back: the check expects the original channels."""
    lab = colour.rgb_to_lab(si.colours(t), keep=("id",)).select("id", "labL", "labA", "labB")
    return colour.lab_to_rgb(lab, keep=("id",)).select("id", *[rounded(F.col(c), 4).alias(c) for c in "RGB"])


@query("mean_iou", """
    , areas as (select t_w * t_h + p_w * p_h as total,
                       greatest(least(t_x + t_w, p_x + p_w) - greatest(t_x, p_x), 0) * greatest(least(t_y + t_h, p_y + p_h) - greatest(t_y, p_y), 0) as shared
                from boxes)
    select count(*) as n, round(avg(shared / (total - shared)), 6) as mean_iou from areas""", ("boxes",))
def mean_iou(t: Tables) -> DataFrame:
    found = si.boxes(t).agg(F.count("*").alias("n"), F.avg(box_iou()).alias("mean_iou"))
    return found.withColumn("mean_iou", rounded(F.col("mean_iou")))


SHOWN = r"regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g')"


def plain_sql(markup: str) -> str:
    text = rf"trim(regexp_replace(regexp_replace({markup}, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


TITLE_SQL = plain_sql("regexp_extract(shown, '(?is)<title[^>]*>(.*?)</title>', 1)")
HEADING_SQL = plain_sql("regexp_extract(shown, '(?is)<h1[^>]*>(.*?)</h1>', 1)")
BODY_SQL = r"regexp_replace(shown, '(?is)<head\b.*?</head>', ' ', 'g')"
# whole opening tags first, then the value after href=, quotes cut off
LINKS_SQL = r"""list_transform(list_filter(regexp_extract_all(shown, '(?i)<a\s[^>]*>'), lambda a: regexp_matches(a, '(?i)\shref\s*=')),
    lambda a: regexp_replace(regexp_extract(a, '(?i)\shref\s*=\s*("[^"]*|''[^'']*|[^\s>]*)', 1), '^["'']', ''))"""


@query("page_titles", f"select page_id, {TITLE_SQL} as title from (select *, {SHOWN} as shown from pages)")
def page_titles(t: Tables) -> DataFrame:
    return pages.page_titles(t.pages)


@query("page_fields", f"""
    select page_id, url, {TITLE_SQL} as title, {HEADING_SQL} as heading, len({LINKS_SQL}) as n_links, {plain_sql(BODY_SQL)} as text
    from (select *, {SHOWN} as shown from pages)""")
def page_fields(t: Tables) -> DataFrame:
    return pages.page_fields(t.pages)


@query("page_links", f"""
    select page_id, href, case when starts_with(href, '//') then split_part(page, '/', 1) || href
                                      when starts_with(href, '/') then array_to_string(string_split(split_part(split_part(page, '#', 1), '?', 1), '/')[1:3], '/') || href
                                      else href end as url
    from (select page_id, url as page, unnest({LINKS_SQL}) as href from (select *, {SHOWN} as shown from pages))""")
def page_links(t: Tables) -> DataFrame:
    return pages.page_links(t.pages)


@query("earliest_year", rf"""
    select page_id, y as year, 2019 - y as age from (
        select page_id, list_min(list_transform(list_filter(regexp_extract_all(body, '\d+'), lambda d: length(d) = 4 and d >= '1000'),
                                                lambda d: cast(d as integer))) as y
        from (select page_id, regexp_replace({BODY_SQL}, '<[^>]*>', ' ', 'g') as body from (select *, {SHOWN} as shown from pages)))""")
def earliest_year(t: Tables) -> DataFrame:
    return pages.earliest_year(t.pages, 2019)
