"""Small page and record builders."""

import json
from pathlib import Path

COMPLETE_ARC = {
    "iu_ac": "71",
    "libelle": "Quay road, east",
    "t_1h": "2031-03-09T05:00:00+00:00",
    "q": 40.5,
    "k": 2.75,
    "etat_trafic": "Fluide",
    "etat_barre": "Ouvert",
    "iu_nd_amont": "12",
    "libelle_nd_amont": "mill gate",
    "iu_nd_aval": "13",
    "libelle_nd_aval": "old harbour",
    "date_debut": "1999-11-30",
    "date_fin": "2030-06-15",
    "geo_point_2d": {"lon": -17.25, "lat": 32.625},
    "geo_shape": {"type": "Polygon", "coordinates": [[[0, 0], [0, 1], [1, 1], [0, 0]]]},
}

COMPLETE_STATION = {
    "stationcode": "S-4",
    "name": "Lighthouse steps",
    "is_installed": "OUI",
    "capacity": 9,
    "numdocksavailable": 7,
    "numbikesavailable": 2,
    "mechanical": 1,
    "ebike": 1,
    "is_renting": "NON",
    "is_returning": "OUI",
    "duedate": "2031-03-09T05:00:00+00:00",
    "coordonnees_geo": {"lon": -17.0, "lat": 32.5},
    "nom_arrondissement_communes": "Lower bay",
    "code_insee_commune": "00417",
    "station_opening_hours": None,
}


def arc(**changes):
    return {**COMPLETE_ARC, **changes}


def station(**changes):
    return {**COMPLETE_STATION, **changes}


def land(root, pages):
    """``pages``: list of (chunk, offset, document); documents may be raw text."""
    for chunk, offset, document in pages:
        folder = Path(root) / f"chunk={chunk}"
        folder.mkdir(parents=True, exist_ok=True)
        text = document if isinstance(document, str) else json.dumps(document)
        (folder / f"offset_{offset}.json").write_text(text)
    return str(root)


def page(total, *records):
    return {"total_count": total, "results": list(records)}
