"""Table layouts."""

from __future__ import annotations

# The columns of a text release, all text, in file order.
RAW_COLUMNS = (
    "OID_ AddNum_Pre Add_Number AddNum_Suf AddNo_Full St_PreMod St_PreDir St_PreTyp St_PreSep St_Name St_PosTyp St_PosDir St_PosMod StNam_Full "
    "Building Floor Unit Room Seat Addtl_Loc SubAddress LandmkName County Inc_Muni Post_City Census_Plc Uninc_Comm Nbrhd_Comm NatAmArea NatAmSub "
    "Urbnztn_PR PlaceOther PlaceNmTyp State Zip_Code Plus_4 UUID AddAuth AddrRefSys Longitude Latitude NatGrid Elevation Placement AddrPoint "
    "Related_ID RelateType ParcelSrc Parcel_ID AddrClass Lifecycle Effective Expire DateUpdate AnomStatus LocatnDesc Addr_Type DeliverTyp NAD_Source DataSet_ID"
).split()

#: The tagged point table; flags are sorted and distinct, a null drop_reason means the point is kept.
POINT_COLUMNS = "nad_uuid nad_oid lon lat addr_housenumber addr_street addr_unit addr_city addr_state addr_postcode nad_source county placement date_update flags drop_reason".split()
