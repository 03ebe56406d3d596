from tremorline.functions.cast import as_bigint, as_double
from tremorline.functions.epoch import local_second, local_subsecond, utc_second
from tremorline.functions.place import area_of, strip

__all__ = [
    "area_of",
    "as_bigint",
    "as_double",
    "local_second",
    "local_subsecond",
    "strip",
    "utc_second",
]
