"""Link keys: the message file name and the same name built from a patient."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: suffix of every per-person message file name.
MESSAGE_FILE_SUFFIX = "TwitterData.json"
# Fixed value: folder name that Spark and Hive give to a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def person_file_key(
    given: Column | str = "Given_Name",
    family: Column | str = "Family_Name",
    identifier: Column | str = "Identifier",
    suffix: str = MESSAGE_FILE_SUFFIX,
) -> Column:
    """``Given_Family_Identifier`` + suffix; NULL parts are skipped."""
    return F.concat(F.concat_ws("_", given, family, identifier), F.lit(suffix))


def file_name_from_path(path: Column | str) -> Column:
    """Last path segment of a file URI, URI-decoded and trimmed.

    Independent of folder depth. ``+`` is literal in a path, so it is
    protected before decoding; malformed escapes leave the name as is.
    """
    p = F.col(path) if isinstance(path, str) else path
    return F.trim(_decoded(F.element_at(F.split(p, "/"), -1)))


def _decoded(text: Column) -> Column:
    """URI-decoded; ``+`` is literal in a path, malformed escapes leave the text as is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def folder_value_from_path(path: Column | str, name: str) -> Column:
    """The value of the partition folder ``name=value`` in a file URI; NULL if
    the path has none.

    Spark escapes a value once when it names the folder, and the URI of a file
    escapes the folder's name again. The value of a NULL partition reads as NULL.
    """
    p = F.col(path) if isinstance(path, str) else path
    folder = F.try_element_at(F.filter(F.split(p, "/"), lambda s: F.startswith(s, F.lit(f"{name}="))), F.lit(-1))
    value = F.substr(folder, F.lit(len(name) + 2))
    return F.nullif(_decoded(_decoded(value)), F.lit(NULL_FOLDER))


def encode_file_name(name: Column | str) -> Column:
    """Inverse of the decode above for the characters a name may carry."""
    n = F.col(name) if isinstance(name, str) else name
    for ch, esc in (("%", "%25"), (" ", "%20"), ("#", "%23"), ("?", "%3F")):
        n = F.replace(n, F.lit(ch), F.lit(esc))
    return n
