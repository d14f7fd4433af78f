"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: token shapes, spelled so that Java and RE2 read them alike
WORD = r"[\p{L}\p{N}_]{2,}"        # words of two or more characters
LETTERS = r"[\p{L}\p{Nl}\p{No}_]{2,}"  # the same without decimal digits
NOT_WORD = r"[^\p{L}\p{N}_\s]"

# fixed values: honorifics and the group each belongs to
TITLE_GROUPS = {
    "Noble": ["Don", "Lady", "Sir", "the Countess", "Jonkheer", "Dona"],
    "Military": ["Major", "Col", "Capt"],
    "Miss": ["Miss", "Mlle", "Ms"],
    "Mrs": ["Mme", "Mrs"],
}
# fixed values: honorifics by the sex they go with
MALE_TITLES = ["Don", "Sir", "Jonkheer", "Rev", "Major", "Col", "Capt", "Mr", "Master"]
FEMALE_TITLES = ["Dona", "Lady", "the Countess", "Mrs", "Miss", "Mme", "Ms", "Mlle"]


def part(text: Column, sep: str, n: int) -> Column:
    """``n``-th piece of a separated text, from 0; negative counts from the end. NULL if absent."""
    pieces = F.split_part(text, F.lit(sep), F.lit(n + 1 if n >= 0 else n))
    size = list_size(text, sep)
    need = n + 1 if n >= 0 else -n
    return F.when(size >= need, pieces)


def list_size(text: Column, sep: str) -> Column:
    """Number of pieces; 0 for NULL and for an empty text."""
    stripped = F.length(F.replace(text, F.lit(sep), F.lit("")))
    count = (F.length(text) - stripped) / len(sep) + 1
    return F.when(text.isNull() | (text == ""), 0).otherwise(count.cast("int"))


def drop_last_tokens(text: Column, n: int = 3, strip: str = "\u0085") -> Column:
    """Remove the control character ``strip`` and the last ``n`` space-separated tokens."""
    tokens = F.split(F.replace(text, F.lit(strip), F.lit("")), " ")
    return F.array_join(F.slice(tokens, 1, F.greatest(F.size(tokens) - n, F.lit(0))), " ")


def clean_quotes(name: Column) -> Column:
    """Tidy quotes in a person name; ``/`` becomes ``-``.

    A quoted single word in a name without parentheses is a nickname and goes with
    its quotes; in every other case only the quote marks go.
    """
    name = F.replace(name, F.lit("/"), F.lit("-"))
    quoted = F.get(F.split(name, '"'), F.lit(1))
    tail = F.coalesce(F.get(F.split(name, '"'), F.lit(2)), F.lit(""))
    nickname = (F.length(quoted) > 1) & ~name.contains("(") & ~name.contains(")") & ~quoted.contains(" ")
    bare = F.replace(name, F.lit('"'), F.lit(""))
    return (
        F.when(~name.contains('"'), name)
        .when(nickname, F.concat(F.substring_index(name, '"', 1), tail))
        .otherwise(bare)
    )


def honorific(name: Column) -> Column:
    """Trimmed text between the first comma and the next full stop; NULL without a comma."""
    after = F.get(F.split(name, ","), F.lit(1))
    return F.trim(F.substring_index(after, ".", 1))


def title_bucket(name: Column) -> Column:
    """Honorific mapped to its group; others stay as they are."""
    title = honorific(name)
    out = F.when(title.isNull(), title)
    for group, members in TITLE_GROUPS.items():
        out = out.when(title.isin(members), group)
    return out.otherwise(title)


def title_agrees(name: Column, sex: Column) -> Column:
    """1 if the honorific goes with the stated sex, else 0."""
    title = honorific(name)
    agrees = (title.isin(MALE_TITLES) & (sex == "male")) | (title.isin(FEMALE_TITLES) & (sex == "female"))
    return F.coalesce(agrees, F.lit(False)).cast("int")


def title_year(title: Column) -> Column:
    """Year in the closing parenthesis of a title; NULL if there is none."""
    return F.regexp_extract(title, r'\((\d{4})\)\s*"?$', 1).try_cast("int")


def clean_token(word: Column) -> Column:
    """Everything but word characters and blanks becomes a blank."""
    return F.regexp_replace(word, NOT_WORD, " ")


def pair_code(a: Column, b: Column) -> Column:
    """The two texts in case-insensitive order, joined; equal for (a, b) and (b, a)."""
    return F.when(F.lower(a) <= F.lower(b), F.concat(a, b)).otherwise(F.concat(b, a))


def tokens(text: Column, pattern: str = WORD) -> Column:
    """Lower-cased tokens in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def bigrams(words: Column) -> Column:
    """Neighbouring pairs of a token array, joined by a blank."""
    first = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.when(
        F.size(words) > 1,
        F.zip_with(first, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))


def genre_score(genres: Column, both: str = "Mystery|Thriller", either=("Mystery", "Thriller")) -> Column:
    """1 if the list holds the literal text ``both``, 0.5 for one member, else 0."""
    one = genres.contains(either[0])
    for e in either[1:]:
        one = one | genres.contains(e)
    return F.when(genres.contains(both), 1.0).when(one, 0.5).otherwise(0.0)
