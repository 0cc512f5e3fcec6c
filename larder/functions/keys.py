"""Object keys, path parts, identifiers and timestamps as column expressions."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions counted as images and documents, and those accepted from an image URL.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp", "bmp", "tiff")
DOCUMENT_EXTENSIONS = ("json", "jsonl", "ndjson")
URL_IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp", "bmp")
URL_IMAGE_MIME = {
    "image/jpeg": "jpg",
    "image/png": "png",
    "image/gif": "gif",
    "image/webp": "webp",
    "image/bmp": "bmp",
}

STRICT_ID_PATTERN = r"(?i)__([A-Za-z0-9_\-]+)_(\d+)\.(?:jpe?g|png|webp|gif|bmp|tiff)$"
LOOSE_ID_PATTERN = r"__([A-Za-z0-9_\-]+)_(\d+)\."
HEX_ID_PATTERN = r"([A-Fa-f0-9]+[0-9]+)\.[^.]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def posix_path(path: Column | str) -> Column:
    """Path with doubled slashes, ``.`` segments and a trailing slash removed; empty becomes ``.``."""
    p = F.regexp_replace(_col(path), "/{2,}", "/")
    p = F.regexp_replace(p, r"(^|/)(?:\./|\.$)+", "$1")
    p = F.regexp_replace(p, "(.)/$", "$1")
    return F.regexp_replace(p, r"^\z", ".")  # like the names below without a branch, which would repeat the whole expression


def file_name(path: Column | str) -> Column:
    """Last path segment, empty for the root and for the current folder."""
    return F.regexp_replace(F.substring_index(posix_path(path), "/", -1), r"^\.\z", "")


def file_stem(path: Column | str) -> Column:
    """File name without its last suffix; a leading or trailing dot is not a suffix."""
    return F.regexp_replace(file_name(path), r"(?s)^(.+)\.[^.]+$", "$1")


def file_suffix(path: Column | str) -> Column:
    """Lower-case suffix without the dot, empty when there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"(?s)^.+\.([^.]+)$", 1))


def sanitize(name: Column | str) -> Column:
    """Replace each run of characters other than letters, digits, ``_``, ``-`` and ``.`` by ``_``."""
    return F.regexp_replace(_col(name), r"[^\p{L}\p{N}_\-.]+", "_")


def object_key(path: Column | str) -> Column:
    """``<16 hex of sha256(path)>__<file name>``."""
    p = posix_path(path)
    name = file_name(path)
    return F.concat(
        F.substring(F.sha2(p, 256), 1, 16),
        F.lit("__"),
        F.when(name == "", F.lit("file")).otherwise(name),
    )


def original_name(key: Column | str) -> Column:
    """File name after the first ``__``, or the whole name."""
    name = file_name(key)
    return F.when(name.contains("__"), F.regexp_replace(name, "(?s)^.*?__", "")).otherwise(name)


def image_key(prefix: Column | str, id_: Column | str, index: Column | str, ext: Column | str) -> Column:
    """``<prefix>/<32 hex of sha256("id:index")>__<id>_<index>.<ext>``."""
    i, n, e = _col(id_), _col(index).cast("string"), _col(ext)
    return F.concat(
        _col(prefix),
        F.lit("/"),
        F.substring(F.sha2(F.concat_ws(":", i, n), 256), 1, 32),
        F.lit("__"),
        F.concat_ws("_", i, n),
        F.lit("."),
        F.coalesce(F.when(e != "", e), F.lit("bin")),
    )


def target_key(
    kind: Column | str,
    dataset: Column | str,
    timestamp: Column | str,
    name: Column | str,
    ext: Column | str,
    prefix: Column | str,
) -> Column:
    """``<prefix>/<kind>$<dataset>$<timestamp>$<name>.<ext>`` with dataset and name sanitised."""
    return F.concat(
        _col(prefix),
        F.lit("/"),
        F.concat_ws("$", _col(kind), sanitize(dataset), _col(timestamp), sanitize(name)),
        F.lit("."),
        _col(ext),
    )


def jpg_key(prefix: Column | str, key: Column | str) -> Column:
    """``<prefix>/<name up to its last dot>.jpg``."""
    stem = F.regexp_replace(file_name(key), r"(?s)\.[^.]*$", "")
    return F.concat(_col(prefix), F.lit("/"), stem, F.lit(".jpg"))


def vector_id(key: Column | str) -> Column:
    return F.replace(_col(key), F.lit("/"), F.lit("__"))


def recipe_id(key: Column | str, strict: bool = False) -> Column:
    """Identifier between ``__`` and ``_<n>.`` in the file name.

    Without a match the file name itself is the identifier, or null when ``strict``; the strict form
    also wants a known image extension.
    """
    name = file_name(key)
    found = F.regexp_extract(name, STRICT_ID_PATTERN if strict else LOOSE_ID_PATTERN, 1)
    matched = F.when(found != "", found)
    return matched if strict else F.coalesce(matched, name)


def image_index_id(key: Column | str) -> Column:
    """Hexadecimal run ending in a digit right before the extension, or the file name."""
    name = file_name(key)
    found = F.regexp_extract(name, HEX_ID_PATTERN, 1)
    return F.coalesce(F.when(found != "", found), name)


def short_tag(key: Column | str) -> Column:
    """Source tag of a file: last ``__`` or ``-_$`` part of its stem, cleaned, lower-case, <= 40 chars."""
    stem = file_stem(key)
    part = F.when(stem.contains("__"), F.element_at(F.split(stem, "__"), -1)).otherwise(
        F.element_at(F.split(stem, "[-_$]+"), -1)
    )
    tag = F.regexp_replace(part, r"[^\p{L}\p{N}_\-]+", "_")
    tag = F.right(F.lower(F.regexp_replace(tag, "^_+|_+$", "")), F.lit(40))
    return F.when(tag == "", F.lit("file")).otherwise(tag)


def mime_type(content_type: Column | str) -> Column:
    """Content type without parameters, trimmed and lower-case; null gives an empty string."""
    return F.lower(F.trim(F.substring_index(F.coalesce(_col(content_type), F.lit("")), ";", 1)))


def mime_extensions() -> dict[str, str]:
    """Extension for each MIME type the Python standard library knows."""
    known = mimetypes.MimeTypes()
    types = sorted(set(known.types_map[True].values()))
    return {t: known.guess_extension(t).lstrip(".") for t in types}


def base_name(key: Column | str) -> Column:
    stem = file_stem(key)
    return F.when(stem == "", F.lit("file")).otherwise(stem)


def extension(key: Column | str, content_type: Column | str | None = None) -> Column:
    """Extension from the suffix, else from the content type; ``jpeg``/``jpe`` -> ``jpg``, else ``bin``."""
    ext = file_suffix(key)
    if content_type is not None:
        guess = F.element_at(_literal_map(mime_extensions()), mime_type(content_type))
        ext = F.when(ext == "", F.coalesce(guess, F.lit(""))).otherwise(ext)
    return F.regexp_replace(F.regexp_replace(ext, r"^jpeg?\z", "jpg"), r"^\z", "bin")


def classify_object(key: Column | str, content_type: Column | str | None = None) -> Column:
    """``image``, ``document`` or ``skip``; the image test is made first."""
    ctype = _col(content_type) if content_type is not None else F.lit(None).cast("string")
    ext = extension(key, ctype)
    raw = F.lower(F.coalesce(ctype, F.lit("")))
    return (
        F.when(raw.startswith("image/") | ext.isin(*IMAGE_EXTENSIONS), F.lit("image"))
        .when(ext.isin(*DOCUMENT_EXTENSIONS) | (mime_type(ctype) == "application/json"), F.lit("document"))
        .otherwise(F.lit("skip"))
    )


def url_path(url: Column | str) -> Column:
    """Path part of a URL by pattern; it also accepts URLs a strict parser rejects."""
    return F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_extension(url: Column | str, content_type: Column | str | None = None) -> Column:
    """Image extension from the URL path, else from the content type, else ``jpg``."""
    ext = file_suffix(url_path(url))
    from_url = F.when(ext == "jpeg", F.lit("jpg")).when(ext.isin(*URL_IMAGE_EXTENSIONS), ext)
    options = [from_url]
    if content_type is not None:
        options.append(F.element_at(_literal_map(URL_IMAGE_MIME), mime_type(content_type)))
    return F.coalesce(*options, F.lit("jpg"))


def utc_timestamp(ts: Column | None = None) -> Column:
    """``yyyy-MM-ddTHH-mm-ssZ`` in UTC, 20 characters."""
    moment = F.current_timestamp() if ts is None else ts
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH-mm-ss'Z'")


def trace_key(query: Column | str, timestamp: Column | str) -> Column:
    """Key of a trace: timestamp plus the first 8 hex digits of the query's SHA-1."""
    return F.concat(
        F.lit("results/generative/rag_multimodal/"),
        _col(timestamp),
        F.lit("_"),
        F.substring(F.sha1(_col(query).cast("binary")), 1, 8),
        F.lit(".json"),
    )
