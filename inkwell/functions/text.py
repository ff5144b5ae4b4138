"""Text shown on a page: escaping, dates, messages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five characters with a meaning in HTML, ampersand first.
HTML_ENTITIES = [
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&#34;"),
    ("'", "&#39;"),
]


def html_escape(text: Column) -> Column:
    for character, entity in HTML_ENTITIES:
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def date_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def byline(username: Column, created: Column) -> Column:
    return F.concat(F.lit("by "), username, F.lit(" on "), date_text(created))


def taken_message(username: Column) -> Column:
    return F.concat(F.lit("User "), username, F.lit(" is already registered."))


def missing_post_message(post_id: Column) -> Column:
    return F.concat(F.lit("Post id "), post_id.cast("string"), F.lit(" doesn't exist."))
