"""Explicit input schemas, by position, in internal names.

Codes (CAS, activity code, postcode) are text: they carry leading zeros.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "t": T.DateType()}


def struct(spec: str) -> T.StructType:
    """``"a b:d c:i"`` to a schema; text where no type is given."""
    fields = [part.partition(":") for part in spec.split()]
    return T.StructType([T.StructField(n, _TYPES[t or "s"]) for n, _, t in fields])


# The header ends with a separator, hence the ninth, always empty column.
NAVIGATOR = struct("substance_group substance cas division branch sub_branch compartment emission_status _pad")

_SCORES = " ".join(f"{s}_score:d {s}_class {s}_explanation" for s in ("pmt", "p", "m", "t"))
PMT = struct(f"cas pmt_name {_SCORES}")
PMT_COLUMNS = [f.name for f in PMT.fields if f.name != "cas"]

NAMES = struct("name_nl name_uk cas ec_nr smiles")
ACTIVITY = struct("division branch sub_branch code code_name activity_nr")
SELECTION = struct("code_decimal process main_group")
COMPANIES = struct("sectors codes street postcode town")
ADDRESSES = struct("address latitude:d longitude:d")
REGISTER = struct(
    "substance_code substance_name company nic code code_name postcode street house_number addition town "
    "compartment compartment_code area_division area_code area source_type sector sub_sector cause cause_code "
    "unit origin origin_code dataset emission:d x:d y:d year:i"
)
MEASUREMENTS = struct("year plant_code location parameter_code substance_name cas register_code median:d")
REGISTER_CODES = struct("register_code:i register_name parameter_code")
PARAMETERS = struct("guid id codes omschrijving casnummer begin_geldigheid eind_geldigheid")
COMPOUNDS = struct("cas cid formula smiles inchi inchi_key title mass:d charge:i")
