"""Triples of objects, datastreams, element sets and relationships, and their N-Triples lines."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muniment import model as M
from muniment.functions import ids, xmltext

TRIPLE = ("s", "p", "o", "o_kind", "o_datatype", "o_lang")
DC_FIELDS = "element STRING, pos INT, value STRING"


def _triple(s: Column, p: str | Column, o: Column, datatype: str | Column) -> Column:
    return F.struct(
        s.alias("s"),
        (F.lit(p) if isinstance(p, str) else p).alias("p"),
        o.cast("string").alias("o"),
        F.lit("literal").alias("o_kind"),
        (F.lit(datatype) if isinstance(datatype, str) else datatype).alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"),
    )


def _explode(df: DataFrame, keys: list[str], triples: Column) -> DataFrame:
    return df.select(*keys, F.explode_outer(triples).alias("_t")).select(*keys, "_t.*").where(F.col("o").isNotNull())


def object_triple_array() -> Column:
    """Every property of an object; names containing ``Date`` are dates, the others strings.

    The subject always uses the source's id root, whatever prefix the target objects get.
    """
    subject = F.concat(F.lit(M.ID_ROOT), F.col("pid"))
    return F.transform(
        "properties",
        lambda p: _triple(
            subject, p["name"], p["value"],
            F.when(p["name"].contains("Date"), F.lit(M.XSD_DATETIME)).otherwise(F.lit(M.XSD_STRING)),
        ),
    )


def object_triples(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per property triple of the objects in ``df(pid, properties)``."""
    return _explode(df, keys, object_triple_array())


def datastream_triple_array(plain: bool, prefix: str = M.ID_ROOT) -> Column:
    """Description triples of a datastream version; plain targets also store what a server would manage.

    Reads ``pid, ds_id, state, label, format_uri, created, create_date, mime_type, size, digest_type,
    digest_value, content_kind``.
    """
    s = ids.datastream_resource(F.col("pid"), F.col("ds_id"), prefix)
    made = [
        _triple(s, M.P_TITLE, F.col("label"), M.XSD_STRING),
        _triple(s, M.P_STATE, F.col("state"), M.XSD_STRING),
        _triple(s, M.P_FORMAT, F.col("format_uri"), M.XSD_STRING),
    ]
    if plain:
        shown = F.when(
            F.col("content_kind") != "inline",
            F.lower(F.concat(F.lit("urn:"), F.col("digest_type"), F.lit(":"), F.col("digest_value"))),
        )
        made += [
            _triple(s, M.P_CREATED, F.col("create_date"), M.XSD_DATETIME),
            _triple(s, M.P_LAST_MODIFIED, F.col("created"), M.XSD_DATETIME),
            _triple(s, M.P_IDENTIFIER, F.col("ds_id"), M.XSD_STRING),
            _triple(s, M.P_MIME, F.col("mime_type"), M.XSD_STRING),
            _triple(s, M.P_SIZE, F.when(F.col("size") != -1, F.col("size")), M.XSD_LONG),
            _triple(s, M.P_DIGEST, shown, M.XSD_STRING),
        ]
    return F.array(*made)


def datastream_triples(df: DataFrame, keys: list[str], plain: bool, prefix: str = M.ID_ROOT) -> DataFrame:
    """One row per description triple of the datastream versions in ``df``."""
    return _explode(df, keys, datastream_triple_array(plain, prefix))


def lines_of(triples: Column) -> Column:
    """N-Triples lines of an array of triples, those without an object left out."""
    return F.transform(F.filter(triples, lambda t: t["o"].isNotNull()), lambda t: ntriples_line(lambda name: t[name]))


def extract_dc(df: DataFrame, xml: str = "inline_xml") -> DataFrame:
    """(keys, element, pos, value, parse_error): the element-set values of each document."""
    return xmltext.explode_documents(df, xml, xmltext.dc_rows, DC_FIELDS, "Failed to parse DC XML")


def dc_triples(dc: DataFrame, keys: list[str], subject: Column) -> DataFrame:
    """Element-set values as string triples on the object."""
    return dc.where(F.col("parse_error").isNull()).select(
        *keys,
        subject.alias("s"),
        F.col("element").alias("p"),
        F.col("value").alias("o"),
        F.lit("literal").alias("o_kind"),
        F.lit(M.XSD_STRING).alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"),
    )


def extract_rdf(df: DataFrame, xml: str = "inline_xml") -> DataFrame:
    """(keys, s, p, o, o_kind, o_datatype, o_lang, parse_error): the statements of each RDF/XML document."""
    return xmltext.explode_documents(df, xml, xmltext.rdf_rows, M.TRIPLE_FIELDS, "Failed to parse RDF XML")


def split_rels_int(triples: DataFrame) -> DataFrame:
    """Statements grouped by subject: each goes to the description of the datastream it is about."""
    return triples.withColumn("resource_id", ids.description_resource(F.col("s")))


def download_names(triples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, subject, download_name): one name per subject; the smallest where several are stated."""
    text = F.when(F.col("o_lang").isNotNull(), F.concat("o", F.lit("@"), "o_lang")).otherwise(F.col("o"))
    return (
        triples.where(F.col("p") == M.DOWNLOAD_NAME)
        .groupBy(*keys, F.col("s").alias("subject"))
        .agg(F.min(text).alias("download_name"))
    )


def compose_triples(parts: list[DataFrame]) -> DataFrame:
    """Union of triple tables with equal keys, as a set."""
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def _escaped(text: Column) -> Column:
    for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def ntriples_line(field: Callable[[str], Column] = F.col) -> Column:
    """One N-Triples statement; ``field`` gives the triple's columns (or the fields of a struct)."""

    def resource(c: Column) -> Column:
        return F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))

    tail = (
        F.when(field("o_lang").isNotNull(), F.concat(F.lit("@"), field("o_lang")))
        .when(field("o_datatype").isNull() | (field("o_datatype") == M.XSD_STRING), F.lit(""))
        .otherwise(F.concat(F.lit("^^<"), field("o_datatype"), F.lit(">")))
    )
    target = F.when(
        field("o_kind") == "literal", F.concat(F.lit('"'), _escaped(field("o")), F.lit('"'), tail)
    ).otherwise(resource(field("o")))
    return F.concat(resource(field("s")), F.lit(" <"), field("p"), F.lit("> "), target, F.lit(" ."))


def to_ntriples(triples: DataFrame, keys: list[str]) -> DataFrame:
    """One line per distinct statement and key."""
    return triples.select(*keys, ntriples_line().alias("line")).distinct()
