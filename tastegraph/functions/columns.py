"""Column expressions: titles, genres, ids, cosine, seeded draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The genre vocabulary of the rankers (position = code) and the default release year.
GENRES = [
    "Film-Noir", "Action", "Adventure", "Horror", "Romance", "War", "Comedy", "Western",
    "Documentary", "Sci-Fi", "Drama", "Thriller", "Crime", "Fantasy", "Animation", "IMAX",
    "Mystery", "Children", "Musical",
]
DEFAULT_YEAR = 1990
# Node types and the prefixes that carry them inside an id.
NODE_PREFIX = {"item": "movieId:", "user": "userId:", "genre": "genre:"}


def release_year(title) -> Column:
    """Year from a title ending in ``(YYYY)``; 1990 if the title is missing, short or has no year."""
    trimmed = F.btrim(title, F.lit(" \t\r\n"))
    year = F.substring(trimmed, -5, 4).try_cast("int")
    return F.coalesce(F.when(F.length(trimmed) >= 6, year), F.lit(DEFAULT_YEAR))


def genre_list(genres) -> Column:
    return F.split(genres, r"\|")


def first_genres(genres, n: int = 3, prefix: str = "movieGenre") -> list[Column]:
    """The first ``n`` genres as columns; missing ones are NULL."""
    parts = genre_list(genres)
    return [F.get(parts, i).alias(f"{prefix}{i + 1}") for i in range(n)]


def ranked_by_count(values) -> Column:
    """Distinct array entries, most frequent first, ties by first appearance.

    ``array_remove`` counts natively, so a lambda runs once per distinct entry only. Pass a plain
    column: an expression would be evaluated again for each entry.
    """
    scored = F.transform(
        F.array_distinct(values),
        lambda value, i: F.struct(
            F.size(F.array_remove(values, value)).alias("others"), i.alias("first"), value.alias("value")
        ),
    )
    return F.sort_array(scored)["value"]


def typed_node_id(node_type: str, value) -> Column:
    """Id with its node type in front, e.g. ``movieId:12``."""
    return F.concat(F.lit(NODE_PREFIX[node_type]), F.col(value) if isinstance(value, str) else value)


def cosine(product, norm_a, norm_b) -> Column:
    """Cosine from a dot product and two squared norms."""
    return product / (F.sqrt(norm_a) * F.sqrt(norm_b))


def rounded(value, digits: int) -> Column:
    """Round half up on the decimal value, so that the last bit of a double cannot flip a digit."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def draw(*parts, hex_digits: int = 15) -> Column:
    """A seeded draw in ``[0, 16^hex_digits)`` that depends only on ``parts``, not on partitioning."""
    digest = F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts]))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def unit_draw(*parts) -> Column:
    """A seeded draw in ``[0, 1)``."""
    return draw(*parts, hex_digits=8) / F.lit(float(16**8))
