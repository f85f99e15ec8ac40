"""JSON messages: take the text out along a key path, put the verdict in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from wordsieve.functions import tokens as T

DEFAULT_PATH = ("content", "content")
MARKER = "isSensitive"


def _at(obj: Column, *keys: str) -> Column:
    path = "".join("['" + k.replace("'", "\\'") + "']" for k in keys)
    return F.get_json_object(obj, f"${path}")


def _object_at(obj: Column, key: str) -> Column:
    """The member as JSON text when it is an object; a string that holds JSON is none."""
    shape = StructType([StructField(key, MapType(StringType(), StringType()))])
    return F.when(F.from_json(obj, shape).getField(key).isNotNull(), _at(obj, key))


def extract_strict(value: Column, path: Sequence[str] = DEFAULT_PATH) -> Column:
    """Text at the path; broken JSON gives an empty text, a missing key gives null."""
    return F.when(F.json_object_keys(value).isNotNull(), _at(value, *path)).when(
        value.isNotNull() & F.get_json_object(value, "$").isNull(), F.lit("")
    )


def _walk(value: Column, path: Sequence[str], use: Callable[[Column, Column], Column]) -> Column:
    """Hand on the object that should hold the last key, and its keys.

    A level whose key is absent is passed over; both are null after a level that is no object.
    """

    def step(here: Column, keys: Column, rest: Sequence[str]) -> Column:
        if not rest:
            return use(here, keys)
        inner = F.when(F.array_contains(keys, rest[0]), _object_at(here, rest[0])).when(keys.isNotNull(), here)
        return _opened(inner, lambda deeper, its_keys: step(deeper, its_keys, rest[1:]))

    return _opened(value, lambda root, keys: step(root, keys, path[:-1]))


def _opened(value: Column, use: Callable[[Column, Column], Column]) -> Column:
    """A JSON text and its keys; the keys are null unless it is an object."""
    return T.bind(value, lambda v: T.bind(F.json_object_keys(v), lambda keys: use(v, keys)))


def extract_lenient(value: Column, path: Sequence[str] = DEFAULT_PATH) -> Column:
    """Text at the path, passing over intermediate keys that are absent; null when unusable."""
    return _walk(value, path, lambda holder, keys: F.when(keys.isNotNull(), _at(holder, path[-1])))


def extract_text(value: Column, path: Sequence[str] = DEFAULT_PATH, lenient: bool = True) -> Column:
    return extract_lenient(value, path) if lenient else extract_strict(value, path)


# Why a message can't be used; the last where the marker can't be put in for another reason.
UNMARKABLE = "unmarkable"
REASONS = ("null_message", "malformed", "not_an_object", "bad_level", "missing_key", "null_text", "repeated_key", UNMARKABLE)


def reject_reason(value: Column, path: Sequence[str] = DEFAULT_PATH) -> Column:
    """Why the lenient walk cannot use a message; null for a usable one."""

    def below_root(holder: Column, keys: Column) -> Column:
        return (
            F.when(keys.isNull(), "bad_level")
            .when(~F.array_contains(keys, path[-1]), "missing_key")
            .when(_at(holder, path[-1]).isNull(), "null_text")
        )

    def whole(v: Column, keys: Column) -> Column:
        return F.when(F.array_contains(keys, MARKER) & ~takes_apart(v), "repeated_key")

    def reason(v: Column, keys: Column) -> Column:
        return (
            F.when(v.isNull(), "null_message")
            .when(keys.isNotNull(), F.coalesce(_walk(v, path, below_root), whole(v, keys)))
            .when(F.get_json_object(v, "$").isNull(), "malformed")
            .otherwise("not_an_object")
        )

    return _opened(value, reason)


def takes_apart(value: Column) -> Column:
    """Whether an object can be taken apart: no object in it repeats a key."""
    return F.try_parse_json(value).isNotNull()


def mark(value: Column, verdict: Column) -> Column:
    """The same JSON object with the boolean marker at its root; anything but an object gives null.

    The marker is put before the closing brace and the rest stays as it was written. Only an
    object that has a marker already is taken apart; where it repeats a key at any depth that can't be done, and
    the result is null, as ``reject_reason`` tells.
    """

    text = verdict.cast("string")

    def marked(v: Column, keys: Column) -> Column:
        comma = F.when(F.size(keys) > 0, ",").otherwise("")
        put_in = T.bind(
            F.rtrim(v, F.lit(" \t\r\n")),
            lambda body: F.concat(F.substring(body, F.lit(1), F.length(body) - 1), comma, F.lit(f'"{MARKER}":'), text, F.lit("}")),
        )
        kept = F.map_filter(F.from_json(v, "map<string,variant>"), lambda k, _: k != MARKER)
        replaced = F.to_json(F.map_concat(kept, F.create_map(F.lit(MARKER), F.parse_json(text))))
        return F.when(F.array_contains(keys, MARKER), F.when(takes_apart(v), replaced)).when(keys.isNotNull(), put_in)

    return F.when(verdict.isNotNull(), _opened(value, marked))


def wrap(text: Column) -> Column:
    """A message in the default layout around a text."""
    return F.to_json(F.struct(F.struct(text.alias("content")).alias("content")))
