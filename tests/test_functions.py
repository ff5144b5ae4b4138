"""Text functions against plain Python on generated strings."""

import html
import string
import unicodedata
from urllib.parse import quote as percent_encode

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.functions.files import clean_filename, file_extension
from inkwell.functions.text import html_escape
from inkwell.functions.urls import quote

TEXTS = st.lists(
    st.one_of(
        st.text(max_size=30),
        st.text(alphabet="aB9_-. /\t\n\x0b\x1c\"'<>&*~+%é①日", max_size=30),
    ),
    min_size=40,
    max_size=80,
)


def clean(name):
    folded = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    words = "_".join(folded.replace("/", " ").split())
    return "".join(c for c in words if c in string.ascii_letters + string.digits + "_.-").strip("._")


def extension(name):
    return name.rpartition(".")[2].lower() if "." in name else None


@settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(texts=TEXTS)
def test_against_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    for row in df.select(
        t,
        clean_filename(t).alias("clean"),
        quote(t).alias("quoted"),
        html_escape(t).alias("escaped"),
        file_extension(t).alias("extension"),
    ).collect():
        assert row["clean"] == clean(row["t"])
        assert row["quoted"] == percent_encode(row["t"], safe="")
        assert row["escaped"] == html.escape(row["t"]).replace("&quot;", "&#34;").replace("&#x27;", "&#39;")
        assert row["extension"] == extension(row["t"])
