"""Media links of a listing item."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterloom.functions.text import unescape_ampersand

# How an item says that its link is a picture.
IMAGE_HINTS = ("image", "link")
IMAGE_SUFFIXES = (".jpg", ".png", ".gif", ".jpeg")


def _present(urls: Column) -> Column:
    return F.filter(urls, lambda url: url.isNotNull())


def _attached(item: Column, link_of) -> Column:
    """Links of the item's media map, in map order."""
    values = F.map_values(item["media_metadata"])
    links = F.transform(values, lambda v: unescape_ampersand(link_of(v["s"])))
    return F.coalesce(_present(links), F.array().cast("array<string>"))


def media_urls(item: Column, event_type: Column) -> Column:
    """Media links of a post or comment; an empty array when it has none.

    A post is a video, a gallery or a picture link, tried in this order. A
    comment carries attachments whose plain link may be missing in favour of
    an animation.
    """
    none = F.array().cast("array<string>")
    video = F.array(item["secure_media"]["reddit_video"]["fallback_url"])
    link = item["url"]
    picture = F.lit(False)
    for suffix in IMAGE_SUFFIXES:
        picture = picture | link.endswith(suffix)
    post = (
        F.when(item["is_video"], F.filter(video, lambda url: url != ""))
        .when(item["is_gallery"], _attached(item, lambda s: s["u"]))
        .when(item["post_hint"].isin(*IMAGE_HINTS) & picture, F.array(link))
        .otherwise(none)
    )
    comment = _attached(item, lambda s: F.coalesce(s["u"], s["gif"]))
    return F.when(event_type == "POST", post).when(event_type == "COMMENT", comment).otherwise(none)
