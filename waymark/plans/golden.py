"""Worked examples of the rules that SQL cannot express: inputs, and the results that the rules' descriptions give for them."""

from __future__ import annotations

#: (fields, street, flags); fields not named are null.
STREETS: list[tuple[dict[str, str], str | None, str]] = [
    ({"St_Name": "WILLOW", "St_PosTyp": "Lane"}, "Willow Lane", ""),
    ({"St_Name": "WILLOW LN S"}, "Willow Lane South", "name_had_directional,name_had_type"),
    ({"St_Name": "E HARBOR PKWY"}, "East Harbor Parkway", "name_had_directional,name_had_type"),
    ({"St_Name": "CEDAR ST ST"}, "Cedar Street", "duplicate_type,name_had_type"),
    ({"St_Name": "ST BRENDAN", "St_PosTyp": "RD"}, "Saint Brendan Road", "expanded_st"),
    ({"St_Name": "ST ZEBULON", "St_PosTyp": "Road"}, "Saint Zebulon Road", "st_saint_unlisted"),
    ({"St_Name": "ST RD 44"}, "State Road 44", "expanded_st"),
    ({"St_Name": "ST"}, "St", "ambiguous_st"),
    ({"St_Name": "OLD MILL ST HARWICH"}, "Old Mill Street Harwich", "st_street_interior"),
    ({"St_Name": "MOUNT ST MONICA", "St_PosTyp": "Way"}, "Mount Saint Monica Way", "expanded_st"),
    ({"St_Name": "STE ADELE", "St_PosTyp": "Drive"}, "Sainte Adele Drive", "expanded_st"),
    ({"St_Name": "QUARRY STE 9"}, "Quarry Ste 9", "suite_in_street_name"),
    ({"St_Name": "DR SALK", "St_PosTyp": "Boulevard"}, "Doctor Salk Boulevard", "expanded_dr_doctor"),
    ({"St_Name": "DR PEPPER", "St_PosTyp": "DR"}, "Dr Pepper Drive", ""),
    ({"St_Name": "DR"}, "Drive", "expanded_dr_drive"),
    ({"St_Name": "DR", "St_PosTyp": "Lane"}, "Dr Lane", "ambiguous_dr"),
    ({"St_Name": "DR", "St_PreTyp": "County Highway"}, "County Highway DR", "route_abbreviation"),
    ({"St_Name": "REV DR OTIS BLAKE", "St_PosTyp": "Avenue"}, "Reverend Doctor Otis Blake Avenue", "expanded_dr_doctor"),
    ({"St_Name": "LAUREL DR UNIT"}, "Laurel Drive Unit", "expanded_dr_drive"),
    ({"St_Name": "LAUREL DR HILLTOP"}, "Laurel Dr Hilltop", "ambiguous_dr"),
    ({"St_Name": "RTE 12"}, "Route 12", ""),
    ({"St_Name": "CR 250"}, "County Road 250", ""),
    ({"St_Name": "CO RD 9"}, "County Road 9", ""),
    ({"St_Name": "US HWY 20"}, "US Highway 20", ""),
    ({"St_Name": "SR 60", "State": "OH"}, "State Route 60", ""),
    ({"St_Name": "SR 60", "State": "IN"}, "SR 60", "route_abbreviation"),
    ({"St_Name": "KY 80"}, "KY 80", "route_abbreviation"),
    ({"St_Name": "IH 35"}, "Interstate 35", ""),
    ({"St_Name": "FS RD 7"}, "Forest Service Road 7", ""),
    ({"St_Name": "USFS ACCESS"}, "USFS Access", ""),
    ({"St_Name": "MT HERMON", "St_PosTyp": "Road"}, "Mount Hermon Road", ""),
    ({"St_Name": "FT WARREN", "St_PosTyp": "Road"}, "Fort Warren Road", ""),
    ({"St_Name": "MC KINNON", "St_PosTyp": "Court"}, "McKinnon Court", ""),
    ({"St_Name": "O'NEIL", "St_PosTyp": "Court"}, "O'Neil Court", ""),
    ({"St_Name": "BAKER'S", "St_PosTyp": "Row"}, "Baker's Row", ""),
    ({"St_Name": "VAN DE GRAAF", "St_PosTyp": "Circle"}, "Van de Graaf Circle", ""),
    ({"St_Name": "W B YEATS", "St_PosTyp": "Way"}, "W B Yeats Way", "initials_not_expanded"),
    ({"St_Name": "AVENUE S"}, "Avenue S", ""),
    ({"St_Name": "HENRY VIII", "St_PosTyp": "Place"}, "Henry VIII Place", ""),
    ({"St_Name": "12", "St_PosTyp": "Street", "State": "KY"}, "12th Street", "ordinal_added"),
    ({"St_Name": "12", "St_PosTyp": "Street", "State": "UT"}, "12 Street", ""),
    ({"St_Name": "312", "St_PosTyp": "Street", "State": "KY"}, "312 Street", "numeric_street_name"),
    ({"St_Name": "101", "St_PosTyp": "Avenue", "State": "NY", "County": "Queens"}, "101st Avenue", "ordinal_added"),
    ({"St_Name": "BEACH 22", "St_PosTyp": "Street", "State": "NY", "County": "Queens County"}, "Beach 22nd Street", "ordinal_added"),
    ({"St_Name": "022ND", "St_PosTyp": "Street"}, "22nd Street", ""),
    ({"St_PreDir": "West", "St_Name": "9", "St_PosTyp": "Place", "St_PosDir": "West", "State": "ND"}, "West 9th Place", "duplicate_directional_dropped,ordinal_added"),
    ({"St_PreDir": "W", "St_Name": "Fern", "St_PosTyp": "Way", "St_PosDir": "W", "State": "WA"}, "West Fern Way West", "repeated_directional"),
    ({"St_Name": "Fern Way West", "St_PosDir": "West"}, "Fern Way West", "duplicate_directional_dropped"),
    ({"St_Name": "Fern Way", "St_PosTyp": "Way"}, "Fern Way", "duplicate_type"),
    ({"St_Name": "FERN DR E", "St_PosDir": "East"}, "Fern Drive East", "duplicate_directional,name_had_type"),
    ({"St_PreMod": "OLD", "St_Name": "FERN", "St_PosTyp": "Trail", "St_PosMod": "EXT"}, "Old Fern Trail Extension", ""),
    ({"St_PreMod": "APT", "St_Name": "FERN", "St_PosTyp": "Trail"}, "Fern Trail", "dropped_pre_modifier"),
    ({"St_Name": "FERN ST EXT", "St_PosMod": "Extension"}, "Fern Street Extension", "duplicate_type,name_had_type"),
    ({"St_PreTyp": "Avenue", "St_PreSep": "of the", "St_Name": "ELMS"}, "Avenue of the Elms", ""),
    ({"St_PreTyp": "Boardwalk"}, "Boardwalk", ""),
    ({"St_Name": "Unknown Lane"}, None, "placeholder_street_name"),
    ({"St_Name": " -- ", "St_PosTyp": "Lane"}, None, "no_street_name"),
]
#: The same for the generated release, which has two other saints.
_OTHER_SAINTS = {
    "ST BRENDAN": ({"St_Name": "ST BARNABAS", "St_PosTyp": "RD"}, "Saint Barnabas Road", "expanded_st"),
    "MOUNT ST MONICA": ({"St_Name": "MOUNT ST MARTHAS", "St_PosTyp": "Way"}, "Mount Saint Marthas Way", "expanded_st"),
}
RELEASE_STREETS = [_OTHER_SAINTS.get(example[0].get("St_Name", ""), example) for example in STREETS]

#: (unit, building, value, flags)
UNITS: list[tuple[str | None, str | None, str | None, str]] = [
    ("apt 4b", None, "Apt 4B", ""),
    ("#  12", None, "#12", ""),
    ("SUITE", None, None, "unit_designator_only"),
    ("ste. 9", "NORTH TOWER", "Ste 9", "building_not_in_unit"),
    (None, "MILL HOUSE", "Mill House", ""),
    ("Mill House", "MILL HOUSE", "Mill House", ""),
    ("unit # c", None, "Unit #C", ""),
    ("rear", None, "Rear", ""),
    ("PH II", None, "Ph II", ""),
    ("n/a", None, None, ""),
    (None, None, None, ""),
]

#: Reference rows (state, name, source) and decisions by state for the city examples.
PLACE_ROWS = [
    ("KS", "Saint Marys", "census_place"), ("KS", "Saint Marys", "wikidata"), ("KS", "St. Marys", "gnis"), ("KS", "McPherson", "census_place"), ("KS", "La Crosse", "census_place"),
    ("KS", "Jonah", "gnis"), ("KS", "Wellsford", "census_place"), ("WI", "La Crosse", "census_place"), ("WI", "Fond du Lac", "census_place"), ("AZ", "Mesa", "census_place"),
    ("AZ", "Quartzsite", "census_place"), ("WI", "Cañon", "census_place"), ("WI", "East Troy", "census_place"),
]
DECISIONS = {
    "KS": [
        {"value": "Welsford Twp", "action": "fix", "county": "Kiowa", "city": "WELLSFORD"},
        {"value": "JONAH", "action": "fix", "county": "Reno", "city": "Jonesville"},
        {"value": "Zone 4", "action": "drop"},
        {"value": "*", "action": "drop", "county": "Pratt"},
        {"value": "Byers Hill", "action": "keep", "county": "Barton"},
    ],
    "*": [{"value": "Unincorporated", "action": "drop"}],
}
#: (post city, municipality, community, state, county, city, flags)
CITIES: list[tuple[str | None, str | None, str | None, str | None, str | None, str | None, str]] = [
    ("ST MARYS", None, None, "KS", None, "Saint Marys", ""),
    ("MC PHERSON", None, None, "KS", None, "McPherson", ""),
    ("LACROSSE", None, None, "WI", None, "La Crosse", ""),
    ("CANON", None, None, "WI", None, "Cañon", ""),
    ("E TROY", None, None, "WI", None, "East Troy", ""),
    ("City of Fond Du Lac", None, None, "WI", None, "Fond du Lac", ""),
    ("Fond Du Lac, WI", None, None, "WI", None, "Fond du Lac", ""),
    ("FOND DU LAC 54935", None, None, "WI", None, "Fond du Lac", ""),
    ("Mesa City", None, None, "AZ", None, "Mesa", ""),
    ("UNINCORPORATED", "Mesa", None, "AZ", None, "Mesa", "city_from_inc_muni"),
    ("Painted Rock Annex", "Mesa", None, "AZ", None, "Mesa", "city_from_inc_muni,unknown_post_city_skipped"),
    ("Painted Rock Annex", "La Crosse", None, "WI", None, "Painted Rock Annex", "city_not_in_reference"),
    ("LA CROSE", "La Crosse", None, "WI", None, "La Crosse", "city_from_inc_muni,unknown_post_city_skipped"),
    ("FDL", None, "Fond du Lac", "WI", None, "Fond du Lac", "city_from_uninc_comm,unknown_post_city_skipped"),
    ("Welsford Twp", None, None, "KS", "Kiowa County", "Wellsford", "city_typo_fixed"),
    ("JONAH", None, None, "KS", "Reno", "Jonesville", "city_typo_fixed,city_not_in_reference"),
    ("JONAH", None, None, "KS", "Ford", "Jonah", ""),
    ("Zone 4", None, None, "KS", None, None, "no_city"),
    ("Sunny Acres", None, None, "KS", "Pratt", None, "no_city"),
    ("BYERS HILL", None, None, "KS", "Barton", "Byers Hill", ""),
    ("Reno County", None, None, "KS", "Reno", None, "no_city"),
    ("RENO", None, None, "KS", "Reno", None, "no_city"),
    ("67501", None, None, "KS", None, None, "no_city"),
    ("US 12 WEST", None, None, "KS", None, None, "no_city"),
    ("QUARTZSITE", None, None, "KS", None, "Quartzsite", "city_not_in_reference"),
    ("HOLLOW OF THE MOON AFB", None, None, "KS", None, "Hollow of the Moon AFB", "city_not_in_reference,city_cased_by_rule"),
    (None, " n/a ", None, "KS", None, None, "no_city"),
]


def sql_values(rows: list[tuple], *columns: str) -> str:
    """The rows as a SQL relation, numbered by k."""
    quoted = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    listed = ", ".join(f"({k}, {', '.join(map(quoted, row))})" for k, row in enumerate(rows))
    return f"(VALUES {listed}) AS g(k, {', '.join(columns)})"
