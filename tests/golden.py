"""The golden fixture of FIXTURES.md: four records and what each layer makes of them."""

from __future__ import annotations

import json
import os

from tarn.functions import RunStamp

RUN = RunStamp(ref=20260115, ref_partition=202601, ts_proc=20260115060000)

FIELDS = (
    "id name brewery_type address_1 address_2 address_3 city state_province postal_code "
    "country longitude latitude phone website_url state street"
).split()


def record(*cells):
    return dict(zip(FIELDS, cells, strict=True))


RECORDS = [
    record(" b1 ", "  Alpha Brewing ", "micro", "1 Main St", None, None, "Austin ", "Texas",
           "78701", "United States", -97.74, 30.27, "5125550100", "http://a.example", "Texas",
           "1 Main St"),
    record("b2", 'Beta "B" Co, Ltd', " micro", None, None, None, "Austin", "Texas", "78702",
           "United States", None, None, None, None, "Texas", None),
    record("b3", "Gamma", "brewpub", "x", "None", None, "Porto Alegre", "RS", "90000-000",
           "Brazil", "-51.2", "bad", "   ", None, "RS", "x"),
    record("b4", "Delta", "nano", *[None] * 13),
]

BRONZE_CSV = """\
id,name,brewery_type,address_1,address_2,address_3,city,state_province,postal_code,country,\
longitude,latitude,phone,website_url,state,street
 b1 ,  Alpha Brewing ,micro,1 Main St,,,Austin ,Texas,78701,United States,-97.74,30.27,\
5125550100,http://a.example,Texas,1 Main St
b2,"Beta ""B"" Co, Ltd", micro,,,,Austin,Texas,78702,United States,,,,,Texas,
b3,Gamma,brewpub,x,,,Porto Alegre,RS,90000-000,Brazil,-51.2,,   ,,RS,x
b4,Delta,nano,,,,,,,,,,,,,
"""

# Attributes of the four rows after the Silver job, before its write.
SILVER = [
    ("b1", "Alpha Brewing", "micro", "1 Main St", None, None, "Austin", "Texas", "78701",
     "United States", -97.74, 30.27, "5125550100", "http://a.example", "Texas", "1 Main St"),
    ("b2", 'Beta "B" Co, Ltd', "micro", None, None, None, "Austin", "Texas", "78702",
     "United States", None, None, None, None, "Texas", None),
    ("b3", "Gamma", "brewpub", "x", None, None, "Porto Alegre", "RS", "90000-000", "Brazil",
     -51.2, None, "", None, "RS", "x"),
    ("b4", "Delta", "nano", *[None] * 13),
]

# coluna: (qt_nulos, percent_nulos, cardinalidade)
SILVER_PROFILE = {
    **dict.fromkeys(["ref", "ref_partition", "ts_proc", "ts_proc_partition"], (0, 0.0, 1)),
    **dict.fromkeys(["id", "name"], (0, 0.0, 4)),
    "brewery_type": (0, 0.0, 3),
    **dict.fromkeys(["address_1", "street"], (2, 50.0, 3)),
    **dict.fromkeys(["address_2", "address_3"], (4, 100.0, 1)),
    **dict.fromkeys(["city", "state_province", "country", "state"], (1, 25.0, 3)),
    "postal_code": (1, 25.0, 4),
    "longitude": (2, 50.0, 3),
    "latitude": (3, 75.0, 2),
    "phone": (2, 50.0, 3),
    "website_url": (3, 75.0, 2),
}

GOLD = [
    ("micro", "Austin", "Texas", "United States", 2, 20260115060000, 202601),
    ("brewpub", "Porto Alegre", "RS", "Brazil", 1, 20260115060000, 202601),
    ("nano", None, None, None, 1, 20260115060000, 202601),
]

GOLD_PROFILE = {
    "brewery_type": (0, 0.0, 3),
    **dict.fromkeys(["city", "state_province", "country"], (1, 33.33, 3)),
    "brewery_count": (0, 0.0, 2),
    **dict.fromkeys(["ts_proc", "ref_partition"], (0, 0.0, 1)),
}


def write_page(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as page:
        json.dump(records, page, ensure_ascii=False, indent=1)


def figures(profile):
    return {
        r["coluna"]: (r["qt_nulos"], r["percent_nulos"], r["cardinalidade"])
        for r in profile.collect()
    }
