"""URL, label, name and page-text functions: Column -> Column, null in, null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Listing names that carry a number, exact case and any case.
LISTING = r"^Update_(\d+)_named_items$"
# Categories with a folder of their own.
CATEGORIES = ("weapon", "armor", "shield", "jewelry", "clothing")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """A captured group, null where the pattern or the group does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _decoded(text: Column) -> Column:
    """Percent-decoded text; a plus stays a plus, and text with broken escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def page_title(url: Column, host: str) -> Column:
    """Title of an article URL of host, null for other hosts, paths, queries and special pages."""
    path = _found(url, rf"^https?://{host.replace('.', '[.]')}/page/([^?#]*)(?:#.*)?$")
    title = F.trim(F.replace(_decoded(path), F.lit("_"), F.lit(" ")))
    return F.when((title != "") & ~F.lower(title).startswith("special:"), title)


def page_key(url: Column) -> Column:
    """One key per page whatever the spelling of its URL."""
    return F.replace(_decoded(F.substring_index(url, "/page/", -1)), F.lit(" "), F.lit("_"))


def url_title(url: Column) -> Column:
    return F.replace(_decoded(F.substring_index(url, "/page/", -1)), F.lit("_"), F.lit(" "))


def listing_url(name: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.replace(name, F.lit(" "), F.lit("_")))


def update_number(listing: Column) -> Column:
    """The number in a listing's name, exact case; null for other names."""
    return _found(listing, LISTING).try_cast("int")


def update_slug(listing: Column) -> Column:
    """update-<number> or unknown; any case, spaces or underscores, leading zeros dropped."""
    number = _found(listing, r"(?i)^Update[ _](\d+)[ _]named[ _]items$").try_cast("int")
    return F.coalesce(F.concat(F.lit("update-"), number.cast("string")), F.lit("unknown"))


def file_slug(name: Column, width: int = 60) -> Column:
    """Lower-case name with runs of other signs as one hyphen, cut to width; null and nothing become item."""
    slug = F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(F.btrim(F.substring(slug, 1, width), F.lit("-")), F.lit("")), F.lit("item"))


def slot_slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))


def cache_filename(title: Column, width: int = 80) -> Column:
    """A file name for a title: readable part, then eight digits that tell equal ones apart."""
    slug = F.substring(F.btrim(F.regexp_replace(title, "[^A-Za-z0-9]+", "_"), F.lit("_")), 1, width)
    return F.concat(F.coalesce(F.nullif(slug, F.lit("")), F.lit("page")), F.lit("-"), F.substring(F.sha1(title), 1, 8), F.lit(".html"))


def clean_text(text: Column) -> Column:
    """White space, no-break spaces among it, becomes one space; ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_label(text: Column) -> Column:
    """A row's label: clean, lower case, without trailing colons."""
    return F.lower(F.rtrim(F.rtrim(clean_text(text), F.lit(":"))))


def page_number(html: Column, key: str) -> Column:
    """The first number of a key in a page's settings, e.g. wgArticleId."""
    return _found(html, rf'"{key}":(\d+)').try_cast("bigint")


def page_meta(html: Column) -> Column:
    """struct(page_id, revision_id, title, name): the first heading without markup, and the same without Item:."""
    heading = F.trim(F.regexp_replace(_found(html, r"(?s)<h1[^>]*>(.*?)</h1>"), "<[^>]*>", ""))
    return F.struct(
        page_number(html, "wgArticleId").alias("page_id"),
        page_number(html, "wgRevisionId").alias("revision_id"),
        heading.alias("title"),
        F.trim(F.regexp_replace(heading, "^Item:", "")).alias("name"),
    )


def page_categories(html: Column) -> Column:
    """The page's categories; unreadable lists are empty, members other than strings dropped."""
    listed = F.from_json(_found(html, r'"wgCategories":(\[[^\]]*\])'), "array<variant>")
    # A variant casts to string from any scalar; only JSON strings keep their quotes when rendered.
    strings = F.filter(listed, lambda v: F.schema_of_variant(v) == "STRING")
    return F.coalesce(F.transform(strings, lambda v: F.variant_get(v, "$", "string")), F.array().cast("array<string>"))


def item_name(title: Column) -> Column:
    """Name of an item page from its link title."""
    return F.trim(F.replace(F.regexp_replace(title, "^Item:", ""), F.lit("_"), F.lit(" ")))


def category_folder(category: Column) -> Column:
    return F.when(category.isin(*CATEGORIES), category).otherwise("other")


def robots_token(agent: Column) -> Column:
    """Product token of a user agent, lower case."""
    return F.lower(F.coalesce(_found(F.trim(agent), "^([A-Za-z_-]+)"), agent))
