"""Keys, archive names and catalog links as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODEL_PREFIX = "lm-"


def key_part(key: Column, part: int) -> Column:
    """Part 1 or 2 of ``datasets/<category>/<name>``; '' for any other shape."""
    parts = F.split(key, "/", -1)
    whole = (F.size(parts) == 3) & (parts[0] == "datasets")
    return F.when(whole, parts[part]).otherwise(F.lit(""))


def key_category(key: Column) -> Column:
    return key_part(key, 1)


def key_filename(key: Column) -> Column:
    return key_part(key, 2)


def archive_name(filename: Column) -> Column:
    """The file name without one ``.zim`` at its end (case counts)."""
    return F.regexp_replace(filename, r"\.zim\z", "")


def model_name(category: Column, prefix: str = MODEL_PREFIX) -> Column:
    return F.concat(F.lit(prefix), category)


def model_category(model: Column, prefix: str = MODEL_PREFIX) -> Column:
    """The category of a model; a name without the prefix is its own category."""
    return F.when(F.startswith(model, F.lit(prefix)), model.substr(F.lit(len(prefix) + 1), F.length(model))).otherwise(model)


def flavour_rank(flavour: Column) -> Column:
    """Preference among the variants of an archive, best first."""
    return (
        F.when(flavour == "nopic", 0).when(flavour == "maxi", 1).when(flavour == "mini", 2).when(F.coalesce(flavour, F.lit("")) == "", 3).otherwise(4)
    )


def archive_filename(href: Column) -> Column:
    """The archive's file name in a link: no query or fragment, no final slash, no ``.meta4``; '' unless it is an archive."""
    path = F.regexp_replace(F.regexp_extract(href, r"\A([^?#]*)", 1), r"/\z", "")
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"\.meta4\z", "")
    return F.when(F.lower(name).endswith(".zim"), name).otherwise(F.lit(""))


def acquisition(links: Column) -> Column:
    """The link to fetch: the first of an archive type, else the first whose relation is an acquisition."""
    typed = F.filter(links, lambda x: F.contains(x["_type"], F.lit("x-zim")))
    related = F.filter(links, lambda x: F.contains(x["_rel"], F.lit("acquisition")))
    return F.coalesce(F.try_element_at(typed, F.lit(1)), F.try_element_at(related, F.lit(1)))


def env_with(env: Column, name: str, value: str) -> Column:
    """A list of NAME=value entries in which one name has the given value, at the end."""
    return F.concat(F.filter(env, lambda e: ~F.startswith(e, F.lit(f"{name}="))), F.array(F.lit(f"{name}={value}")))
