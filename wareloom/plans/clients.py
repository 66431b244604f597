"""A stand-in geocoding client for the registered client query.

It answers from the address text alone (the customer number in
``Customer#000000123, NATION``), so its answers are reproducible in SQL; a
real client would call a geocoding service.  Made once per partition.
"""

from __future__ import annotations

import re
from decimal import Decimal

_NUMBER = re.compile(r"#(\d+)")


def make_customer_client():
    def geocode(addresses: list[str]):
        out = []
        for a in addresses:
            m = _NUMBER.search(a or "")
            if not m or int(m.group(1)) % 11 == 0:
                out.append(None)  # no candidate found
                continue
            k = int(m.group(1))
            out.append((float(Decimal(-80) + Decimal(k % 100) * Decimal("0.1")),
                        float(Decimal(40) + Decimal(k % 50) * Decimal("0.1"))))
        return out
    return geocode
