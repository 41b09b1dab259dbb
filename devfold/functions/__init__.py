"""Column functions; all of them stay inside the JVM."""

from devfold.functions.scalars import (
    encode_gender,
    group_concat,
    hash_bucket,
    label_map,
    time_slice,
    to_int,
)

__all__ = ["encode_gender", "group_concat", "hash_bucket", "label_map", "time_slice", "to_int"]
