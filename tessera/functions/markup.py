"""Mark-up of the game's texts as HTML, avatars as bytes, heights between corners, names of files."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TAG = re.compile(r"<(/?)(\w+)(?:=(\w+))?>")


def _escape(text: str) -> str:
    return html.escape(text, quote=True).replace("&#x27;", "&#39;")


def markup(text: str) -> str:
    """<col=..> and <br> as HTML, all else escaped; colours that stay open are closed. After a tag that makes no sense only what follows it is returned, escaped."""
    out, open_, at = [], 0, 0
    for m in _TAG.finditer(text):
        out.append(_escape(text[at : m.start()]))
        at = m.end()
        closing, name, value = m.groups()
        if closing and name == "col" and open_:
            out.append("</span>")
            open_ -= 1
        elif not closing and name == "br":
            out.append("<br/>")
        elif not closing and name == "col" and value:
            out.append(f'<span style="color:#{value};">')
            open_ += 1
        else:
            return _escape(text[at:])
    return "".join([*out, _escape(text[at:]), "</span>" * open_])


@F.pandas_udf(StringType())
def markup_html(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else markup(t))


def avatar_bytes(text: Column) -> Column:
    """Base64 with * for + and - for /."""
    return F.unbase64(F.translate(text, "*-", "+/"))


def between_corners(x: Column, z: Column, y00: Column, y01: Column, y10: Column, y11: Column) -> Column:
    """The height at a place inside a tile: y01 is the corner along x, y10 that along z."""
    fx, fz = x - F.floor(x), z - F.floor(z)
    return y00 * (1 - fx) * (1 - fz) + y01 * fx * (1 - fz) + y10 * (1 - fx) * fz + y11 * fx * fz
