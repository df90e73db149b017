"""Column expressions over raw JSON text.  All built-in (JVM, codegen) except two that rewrite index definitions.

Documents and index definitions are kept as raw text; these expressions look inside without rewriting the
text of anything they do not have to change.
"""

from __future__ import annotations

import sys

import json

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doc_id(doc) -> Column:
    """JSON text of the document's ``_id`` value: ``1`` and ``"1"`` stay distinct, objects are kept.

    Only the ``_id`` field is materialised (the rest of the document is skipped by the parser).
    NULL when the document has no ``_id``, a null one, or is not a JSON object.
    """
    v = F.from_json(_c(doc), "struct<_id: variant>").getField("_id")
    return F.nullif(F.to_json(v), F.lit("null"))


def is_id_index(keys) -> Column:
    """True when the key *set* of the index is all ``_id`` (``{}`` included); false for non-objects."""
    return F.coalesce(F.forall(F.json_object_keys(_c(keys)), lambda k: k == F.lit("_id")), F.lit(False))


def has_weights_all(options) -> Column:
    """True when ``options.weights`` is an object with a ``$all`` key, whatever its value (null included)."""
    w = F.from_json(_c(options), "struct<weights: variant>").getField("weights")
    found = F.array_contains(F.json_object_keys(F.to_json(w)), F.lit("$all"))
    return F.coalesce(F.startswith(F.schema_of_variant(w), F.lit("OBJECT")) & found, F.lit(False))


def prepare_options(options) -> Column:
    """Index options as they are sent for creation: ``weights`` removed only when it carries ``$all``; all other
    members keep their order and the text of their numbers."""
    o = _c(options)
    return F.when(has_weights_all(o), _drop_weights_udf(o)).otherwise(o)


def index_name(keys, options) -> Column:
    """Identity of an index inside one type: its ``options.name``, else its keys in canonical form."""
    canon = F.to_json(F.from_json(_c(keys), "map<string,variant>"))
    return F.coalesce(F.get_json_object(_c(options), "$.name"), F.concat(F.lit("keys:"), F.coalesce(canon, _c(keys))))


class _Obj(list):
    """Object members in document order."""


class _Num(str):
    """A number kept as its original text."""


def _load(text: str):
    return json.loads(text, object_pairs_hook=_Obj, parse_float=_Num, parse_int=_Num,
                      parse_constant=_Num)


def _dump(v, nulls: bool = False) -> str:
    if isinstance(v, _Obj):
        return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + _dump(x, nulls) for k, x in v if nulls or x is not None) + "}"
    if isinstance(v, list):
        return "[" + ",".join(_dump(x, nulls) for x in v) + "]"
    if isinstance(v, _Num):
        return str(v)
    if v is None:
        return "null"
    if v is True:
        return "true"
    if v is False:
        return "false"
    return json.dumps(v, ensure_ascii=False)


def strip_nulls(text: str | None) -> str | None:
    """Drop null-valued object members at every depth (nulls inside arrays stay); order and numbers kept.

    A top-level null becomes None (absent).
    """
    if text is None:
        return None
    try:
        v = _load(text)
    except ValueError:
        return text
    if v is None:
        return None
    return _dump(v)


def drop_member(text: str | None, name: str) -> str | None:
    """An object's text without its top-level member ``name``."""
    if text is None:
        return None
    v = _load(text)
    return _dump(_Obj((k, x) for k, x in v if k != name), nulls=True) if isinstance(v, _Obj) else text


def _safe_member(text: str | None) -> str | None:
    try:
        return drop_member(text, "weights")
    except ValueError:  # not an object: the condition around the call leaves it out
        return text


@F.pandas_udf(T.StringType())
def _drop_weights_udf(s: pd.Series) -> pd.Series:
    return s.map(_safe_member)


@F.pandas_udf(T.StringType())
def _strip_nulls_udf(s: pd.Series) -> pd.Series:
    return s.map(strip_nulls)


def drop_null_fields(text) -> Column:
    """Null members removed from index JSON; text without ``null`` is passed on as it is.  Spark evaluates the Python
    function for every row of the (small) index table."""
    t = _c(text)
    return F.when(F.instr(t, "null") > 0, _strip_nulls_udf(t)).otherwise(t)


# Ship this module's Python code with its UDFs, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
