"""Hand-written registry documents (FIXTURES.md section 5) as JSON strings."""

from __future__ import annotations

import json


def _iv(payload: dict, start, end=None) -> dict:
    out = dict(payload)
    if start is not None:
        out["nrWpisuWprow"] = str(start)
    if end is not None:
        out["nrWpisuWykr"] = str(end)
    return out


def document(
    entries,
    names=(),
    identifiers=(),
    legal=(),
    opp=(),
    address=(),
    capital=(),
    units=None,
    issues=None,
    statute=None,
    foreign=False,
) -> str:
    """A registry document; ``foreign`` uses the foreign dialect's section keys."""
    subject = {
        "nazwa": [_iv({"nazwa": n}, s, e) for n, s, e in names],
        "identyfikatory": [_iv({"identyfikatory": {"nip": nip, "regon": regon}}, s, e) for nip, regon, s, e in identifiers],
        "formaPrawna": [_iv({"formaPrawna": f}, s, e) for f, s, e in legal],
        "czyPosiadaStatusOPP": [_iv({"czyPosiadaStatusOPP": b}, s, e) for b, s, e in opp],
    }
    seat = {
        "adres": [
            _iv({"kraj": "POLSKA", "ulica": street, "nrDomu": "1", "miejscowosc": city}, s, e)
            for street, city, s, e in address
        ],
        "siedziba": [_iv({"kraj": "POLSKA", "miejscowosc": city, "wojewodztwo": "MAZOWIECKIE"}, s, e) for _, city, s, e in address],
    }
    section = {
        "danePodmiotuZagranicznego" if foreign else "danePodmiotu": subject,
        "siedzibaIAdresPodmiotuZagranicznego" if foreign else "siedzibaIAdres": seat,
        "kapital": {"wysokoscKapitaluZakladowego": [_iv({"waluta": "PLN", "wartosc": v}, s, e) for v, s, e in capital]},
    }
    if units is not None:
        section["kapital"]["lacznaLiczbaAkcjiUdzialow"] = [_iv({"lacznaLiczbaAkcjiUdzialow": u}, s, e) for u, s, e in units]
    if issues is not None:
        section["emisjeAkcji"] = [
            {
                "nazwaSeriiAkcji": [_iv({"nazwaSeriiAkcji": n}, s) for n, s in issue.get("series", [])],
                "liczbaAkcjiWSerii": [_iv({"liczbaAkcjiWSerii": c}, s) for c, s in issue.get("counts", [])],
                "czyAkcjeUprzywilejowaneLiczbaAkcjiRodzajUprzywilejowania": [
                    _iv({"czyAkcjeUprzywilejowaneLiczbaAkcjiRodzajUprzywilejowania": p}, s) for p, s in issue.get("prefs", [])
                ],
            }
            for issue in issues
        ]
    if statute is not None:
        section["umowaStatut"] = {
            "informacjaOZawarciuZmianieUmowyStatutu": [
                {"pozycja": [_iv({"zawarcieZmianaUmowyStatutu": t}, s, e) for t, s, e in group]} for group in statute
            ]
        }
    wpis = [
        {
            "opis": f"entry {n}",
            "dataWpisu": date,
            "numerWpisu": str(n),
            "oznaczenieSaduDokonujacegoWpisu": "SR",
            "sygnaturaAktSprawyDotyczacejWpisu": f"WA/{n}",
        }
        for n, date in entries
    ]
    return json.dumps({"odpis": {"dane": {"dzial1": section}, "naglowekP": {"wpis": wpis}}}, ensure_ascii=False)


ENTRIES_9 = [(n, f"{n:02d}.01.2020") for n in range(1, 10)]

COMMON = dict(
    names=[("Alpha", 1, 3), ("Beta", 3, None)],
    identifiers=[("111", "222", 1, None)],
    legal=[("SPÓŁKA", 1, None)],
    opp=[(True, 2, None)],
    address=[("Long", "Warsaw", 1, 4), ("Short", "Krakow", 4, None)],
    capital=[("5000", 1, 6)],  # orphan: nothing starts at 6 -> reopened
    issues=[
        {"series": [("A", 2)], "counts": [("100", 2)], "prefs": [("x", 2)]},
        {"series": [("B", 2)], "counts": [("200", 2)], "prefs": [("y", 2)]},
    ],
    statute=[[("founded", 1, 5)], [("changed", 5, None)]],
)


def raw_rows():
    """(id, krs_number, raw_data): domestic, its foreign twin, a stale duplicate, malformed."""
    return [
        (10, "0000000001", document(ENTRIES_9, **COMMON)),
        (20, "0000000001", document(ENTRIES_9[:2], names=[("Stale", 1, None)])),
        (30, "0000000002", document(ENTRIES_9, foreign=True, **COMMON)),
        (40, "0000000003", "{bad"),
        (50, "0000000004", document([(1, "01.01.2021")], names=[('Firma "danePodmiotuZagranicznego" SA', 1, None)])),
    ]
