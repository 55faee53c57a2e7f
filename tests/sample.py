"""A configuration folder and report tree for the tests: a water laboratory's results.

Only the configuration's property names are given (a user's files must have them); vocabulary,
limits and layouts are invented here. The reports are generated, a small one or several for each
rule, together with the rows that the rule demands of them (``EXPECTED``).
"""

from __future__ import annotations

import json
from collections import defaultdict
from pathlib import Path

# canonical name, value type, unit, aliases
TESTS = [
    ("Turbidity", "numeric", "NTU", ["cloudiness", "turb."]),
    ("Dissolved Oxygen", "numeric", "mg per L", ["oxygen, dissolved", "DO2"]),
    ("Electrical Conductivity", "numeric", "uS/cm", ["EC at 25", "specific conductance"]),
    ("Free Chlorine", "numeric", "ppm", ["chlorine residual (free)"]),
    ("Nitrate Nitrogen", "numeric", "ppm", ["NO3-N"]),
    ("Phosphate", "numeric", "ppm", ["ortho phosphorus"]),
    ("Total Hardness", "numeric", "dH", []),
    ("Water Temperature", "numeric", "degC", ["temperature of water"]),
    ("Coliform Colonies", "numeric", "cfu", ["coliform plate result"]),
    ("Sampling Depth Below The Water Table", "numeric", "metre", []),
    ("Sand", "numeric", "share", ["sand part"]),
    ("Silt", "numeric", "share", []),
    ("Clay", "numeric", "share", ["clay part"]),
    ("Flow Rate", "numeric", "L per s", ["discharge"]),
    ("Odour", "text", None, ["smell"]),
    ("Manganese", "numeric", "ppb", []),
]
# low, high, outlier low, outlier high
RANGES = {
    "Turbidity": (0.5, 6, 0.02, 900),
    "Dissolved Oxygen": (5.5, 11, 0.5, 24),
    "Electrical Conductivity": (150, 1200, 15, 30000),
    "Free Chlorine": (0.2, 0.8, 0.0, 6),
    "Nitrate Nitrogen": (0.5, 9, 0.0, 80),
    "Phosphate": (0.01, 0.3, 0.0, 12),
    "Total Hardness": (4, 18, 0.2, 70),
    "Water Temperature": (7, 23, -2, 45),
    "Coliform Colonies": (0, 12, 0, 4000),
    "Sampling Depth Below The Water Table": (1, 8, 0.1, 60),
    "Sand": (5, 85, 0, 100),
    "Silt": (5, 60, 0, 100),
    "Clay": (2, 55, 0, 100),
    "Flow Rate": (3, 50, 0.1, 700),
}
UNITS = {
    "ntu": ("NTU", 1.0), "mg per l": ("mg per L", 1.0), "us/cm": ("uS/cm", 1.0),
    "mS/cm": ("uS/cm", 1000.0), "ppm": ("ppm", 1.0), "ppb": ("ppb", 1.0), "dh": ("dH", 1.0),
    "degc": ("degC", 1.0), "cfu": ("cfu", 1.0), "share": ("share", 1.0), "metre": ("metre", 1.0),
    "cm": ("metre", 0.01), "": (None, 1.0),
}
# generic name, class, brands
MEDICINES = [
    ("Zalvorin", "soother", ["Calmex", "Zal"]),
    ("Orpanol", "binder", ["Orp"]),
    ("Brenta Salt", "rinse", ["BS", "0.5% Brenta"]),
]

# A bundle of parts, each of its own sort.
BUNDLE = {
    "source_system": "bundle_1", "date_format": "%d/%m/%Y",
    "match": {"strategy": "envelope_shape", "required_keys": ["parcel", "stamp"]},
    "envelope": {
        "trace_id_path": "stamp", "document_id_path": "parcel.ref.paper",
        "correlation_id_path": "parcel.ref.batch", "meta_details_path": "parcel.tags",
        "blocks_path": "parcel.inside.parts", "record_type_field": "sort",
        "record_type_map": {"panel": "lab_report", "stay": "discharge_summary",
                            "picture": "imaging"}},
    "lab_report": {
        "basic_info_path": "who",
        "demographics_field_map": {
            "uhid": "card", "age": "years old", "gender": "sex.code", "hospital_name": "station",
            "patient_name": "called", "bill_date": "paid", "reports_date": "signed"},
        "rows_path": "sheet.lines",
        "row_field_map": {"test_name": "what", "result_text": "found", "unit_original": "in",
                          "range_text": "limits", "page_number": "leaf"},
        "skip_rows_where": {"what": "what", "found": "found"}},
    "discharge_summary": {
        "root_path": "stay",
        "field_map": {
            "patient_name": "guest", "age": "years old", "gender": "sex.code",
            "hospital_name": "house", "admission_date": "came", "discharge_date": "left",
            "diagnosis": "finding", "course_during_hospitalisation": "diary",
            "medicine_injections_investigation": "given"},
        "medications_path": "stay.take home",
        "medication_field_map": {"medicine": "name", "dose": "much", "frequency": "often"}},
    "dedup_key_fields": ["document_id", "correlation_id"],
}
# Rows and person at the top level, member names with blanks.
OPEN = {
    "clinic_id": "hill_labs", "source_system": "open_2", "date_format": "%Y-%m-%d",
    "match": {"strategy": "envelope_shape", "required_keys": ["Readings", "Form No."]},
    "envelope": {
        "trace_id_path": "Form No", "document_id_path": "Form No", "correlation_id_path": "Round",
        "blocks_path": None, "record_type_field": None,
        "record_type_map": {"default": "lab_report"}},
    "lab_report": {
        "basic_info_path": None,
        "demographics_field_map": {
            "uhid": "Card", "age": "Age", "gender": "Sex", "hospital_name": "Site",
            "patient_name": "Full Name", "bill_date": "Paid on", "reports_date": "Signed on"},
        "rows_path": "Readings",
        "row_field_map": {"test_name": "Quantity", "result_text": "Reading",
                          "unit_original": "Scale", "range_text": "From - To",
                          "page_number": None},
        "skip_rows_where": {}},
    "discharge_summary": None,
    "dedup_key_fields": ["document_id"],
}
# A document tree, three levels down.
TREE = {
    "clinic_id": "river_hospital", "source_system": "tree_1", "date_format": "%m/%d/%Y",
    "match": {"strategy": "envelope_shape", "required_keys": ["document"]},
    "envelope": {
        "trace_id_path": "document.head.run", "document_id_path": "document.head.nr",
        "correlation_id_path": "document.head.visit", "blocks_path": None,
        "record_type_field": None, "record_type_map": {"default": "lab_report"}},
    "lab_report": {
        "basic_info_path": "document.head.person",
        "demographics_field_map": {
            "uhid": "id", "age": "lived", "gender": "is", "hospital_name": "at",
            "patient_name": "label", "bill_date": "charged", "reports_date": "closed"},
        "rows_path": "document.body.table.rows",
        "row_field_map": {"test_name": "c1", "result_text": "c2", "unit_original": "c3",
                          "range_text": "c4", "page_number": None},
        "skip_rows_where": {}},
    "discharge_summary": None,
    "dedup_key_fields": ["document_id", "correlation_id"],
}


def panel(who: dict, lines: list[tuple]) -> dict:
    return {"sort": "panel", "who": who, "sheet": {"lines": [
        dict(zip(("leaf", "limits", "found", "what", "in"), line)) for line in lines]}}


def bundle(stamp: str, paper: str, batch: str, parts, tags: dict | None = None) -> dict:
    return {"stamp": stamp, "parcel": {
        "ref": {"paper": paper, "batch": batch}, "inside": {"parts": parts},
        "tags": [{"key": k, "value": v} for k, v in (tags or {}).items()]}}


UNIT_OF = {name: unit for name, _, unit, _ in TESTS}
#: Report file -> rows that must come of it: (original name, canonical, value, unit, status).
EXPECTED: dict[str, list[tuple]] = defaultdict(list)
REPORTS: dict[str, dict] = {}


def report(rule: str, lines: list[tuple], *, who: dict | None = None, clinic: str = "north_lab",
           more=(), tags: dict | None = None) -> str:
    """A report of one panel; ``lines`` are (name, result, unit, limits, leaf, expected or None)."""
    path = f"{clinic}/2024-09-{len(REPORTS) + 1:02d}/{rule}.json"
    rows = [(leaf, limits, found, what, unit) for what, found, unit, limits, leaf, _ in lines]
    REPORTS[path] = bundle(f"stamp {rule}", f"paper {rule}", f"batch {rule}",
                           [panel(who or {}, rows), *more], tags)
    EXPECTED[path] += [want for *_, want in lines if want]
    return path


def line(name, result, unit="", want=None, *, limits="", leaf=1):
    return name, result, unit, limits, leaf, want


# Where a value lies among its limits -> the value, and its status. Limits belong to the range.
PLACES = {
    "under": (lambda lo, hi, out_lo, out_hi: out_lo - 1, "Outlier"),
    "low": (lambda lo, hi, out_lo, out_hi: (out_lo + lo) / 2, "Below Range"),
    "at_low": (lambda lo, hi, out_lo, out_hi: lo, "Within Range"),
    "middle": (lambda lo, hi, out_lo, out_hi: (lo + hi) / 2, "Within Range"),
    "at_high": (lambda lo, hi, out_lo, out_hi: hi, "Within Range"),
    "high": (lambda lo, hi, out_lo, out_hi: (hi + out_hi) / 2, "Above Range"),
    "over": (lambda lo, hi, out_lo, out_hi: out_hi + 1, "Outlier"),
}
for place, (value, status) in PLACES.items():
    lines = []
    for name, (lo, hi, out_lo, out_hi) in RANGES.items():
        if place == "low" and lo == out_lo:
            continue
        x = round(value(lo, hi, out_lo, out_hi), 4)
        lines.append(line(name.upper() if place == "high" else name, f"{x:g}", "", (
            name.upper() if place == "high" else name, name, x, UNIT_OF[name], status)))
    report(f"place_{place}", lines)

# Aliases stand for their test; names cut at either end still do; others stay unresolved, their
# number parsed but not judged.
IN_RANGE = {name: (lo + hi) / 2 for name, (lo, hi, _, _) in RANGES.items()}


def named(spoken: str, name: str) -> tuple:
    x = IN_RANGE[name]
    return line(spoken, f"{x:g}", "", (spoken, name, x, UNIT_OF[name], "Within Range"))


report("aliases", [named(alias, name) for name, kind, _, aliases in TESTS if kind == "numeric"
                   for alias in aliases])
LONG = [name for name in RANGES if len(name) > 14]
report("cut_in_front", [named(name[2:], name) for name in LONG])
report("cut_at_the_end", [named(name[:len(name) - 3], name) for name in LONG])
UNKNOWN = [f"{x} of unknown make" for x in ("barge", "plank")]
report("unresolved", [line(x, "8", "", (x, "UNRESOLVED", 8.0, None, "Not Applicable")) for x in UNKNOWN])

# Units: stored converted, compared as reported; unknown spellings count as the expected unit.
report("units", [
    line("Electrical Conductivity", "0.9", "mS/cm",
         ("Electrical Conductivity", "Electrical Conductivity", 900.0, "uS/cm", "Outlier")),
    line("Sampling Depth Below The Water Table", "5", "cm",
         ("Sampling Depth Below The Water Table",) * 2 + (0.05, "metre", "Within Range")),
    line("Flow Rate", "20", "buckets", ("Flow Rate", "Flow Rate", 20.0, "L per s", "Within Range")),
    line("Turbidity", "2", " NTU ", ("Turbidity", "Turbidity", 2.0, "NTU", "Within Range")),
])
MISMATCHES = [("Total Hardness", "ntu"), ("Water Temperature", "cfu"), ("Phosphate", "metre")]
report("other_units", [line(name, "3", unit) for name, unit in MISMATCHES])

# Results that are no plain number.
report("results", [
    line("Phosphate", "murky", "", ("Phosphate", "Phosphate", None, "ppm", "Invalid")),
    line("Free Chlorine", "", "", ("Free Chlorine", "Free Chlorine", None, "ppm", "Unclassified")),
    line("Water Temperature", "17 - 18", "", (
        "Water Temperature", "Water Temperature", None, "degC", "Invalid")),
    line("Odour", "5", "", ("Odour", "Odour", 5.0, None, "Not Applicable")),
    line("Manganese", "6", "", ("Manganese", "Manganese", 6.0, "ppb", "Unclassified")),
])
# One result of several parts.
SOILS = {"Silt": 31, "clay part": 9, "sand part": 60}
CANON = {"Silt": "Silt", "clay part": "Clay", "sand part": "Sand"}
for n in (2, 3):
    parts = list(SOILS)[:n]
    path = report(f"parts_{n}", [line("grain by grain", ", ".join(f"{p} - {SOILS[p]}" for p in parts))])
    EXPECTED[path] += [(p, CANON[p], float(SOILS[p]), "share", "Within Range") for p in parts]
# Placeholder rows, rows without a name.
report("skipped", [line("what", "found"), line("", "4"), line("  ", "5"), line(None, "6"),
                   named("Turbidity", "Turbidity")])
# A value stated again on later leaves, and one that differs.
REPEATED = ("Nitrate Nitrogen", "Nitrate Nitrogen", 2.5, "ppm", "Within Range")
report("repeated", [line("Nitrate Nitrogen", "2.5", leaf=leaf, want=REPEATED) for leaf in (4, 6, 9)]
       + [line("Nitrate Nitrogen", "2.75", leaf=9, want=REPEATED[:2] + (2.75, "ppm", "Within Range"))])
# Blocks of no known sort, of one that nothing handles, and such as are no objects.
report("odd_blocks", [], more=[{"sort": "letter"}, {"sort": "picture"}, 12, "words", ["list"]])
TAGS = {"claim_no": "claim 31", "source_system": "desk", "nt_code": "code 8"}
report("tags", [named("Silt", "Silt")], tags=TAGS,
       who={"years old": "5Y0M30D", "sex.code": "Female", "signed": "02/01/2024", "paid": "soon"})

STAY = {"sort": "stay", "stay": {
    "guest": "Ann Lee", "years old": "44", "sex.code": "M", "house": "South", "came": "31/12/2023",
    "left": "2024-01-04", "finding": "scale", "diary": "calm", "given": ["BATH"],
    "take home": [{"name": "Brenta Salt", "much": "1", "often": "daily"},
                  {"name": "0.5% brenta syrup", "much": "3", "often": "daily"},
                  {"name": "Nobody's drops", "much": "1", "often": "once"}, 7, {"much": "4"}]}}
MEDICINES_TAKEN = [("Brenta Salt", "generic_confirmed"), ("Brenta Salt", "brand_resolved"),
                   ("Nobody's drops", "unmapped_brand_or_generic"), (None, "missing")]
REPORTS["north_lab/2024-10-30/stay.json"] = bundle("stamp stay", "paper stay", "batch stay", [STAY])
report("other_dates", [named("Clay", "Clay")], clinic="well_lab", who={
    "signed": "09-08-2024", "paid": "30-02-2024", "years old": "71", "sex.code": "?"})

TREE_LINES = [("Sand", "70", "share", "1-90"), ("smell", "sweet", "", ""), ("DO2", "26", "mg per l", "")]
REPORTS["river_hospital/2024-11-05/tree.json"] = {"document": {
    "head": {"run": "run 5", "nr": "nr 5", "visit": "visit 5", "person": {
        "id": "person 5", "label": "Ole Berg", "lived": "8Y2M", "is": "male", "at": "Bank",
        "charged": "11/04/2024", "closed": "13/04/2024"}},
    "body": {"table": {"rows": [dict(zip(("c1", "c2", "c3", "c4"), r)) for r in TREE_LINES]}}}}
EXPECTED["river_hospital/2024-11-05/tree.json"] = [
    ("Sand", "Sand", 70.0, "share", "Within Range"), ("smell", "Odour", None, None, "Not Applicable"),
    ("DO2", "Dissolved Oxygen", 26.0, "mg per L", "Outlier")]


def sheet(form: str, readings: list[tuple]) -> dict:
    return {"Form No": form, "Form No.": 1, "Round": "round " + form, "Card": "card " + form,
            "Full Name": "Kim Dale", "Age": 19, "Sex": "F", "Site": "Top", "Paid on": "2024-06-01",
            "Signed on": "2024-06-02", "Readings": [
                dict(zip(("Quantity", "Reading", "Scale", "From - To"), r)) for r in readings]}


REPORTS["hill_labs/2024-11-06/sheet.json"] = sheet("sheet 6", [
    ("Peculiar reading", "1", "", ""), ("coliform plate result", "14", "cfu", "0.0-9.5")])
EXPECTED["hill_labs/2024-11-06/sheet.json"] = [
    ("Peculiar reading", "UNRESOLVED", 1.0, None, "Not Applicable"),
    ("coliform plate result", "Coliform Colonies", 14.0, "cfu", "Above Range")]
REPORTS["hill_labs/sheet without readings.json"] = sheet("sheet 7", [])


def copied(path: str, **ref) -> dict:
    """A bundle again under other ids. Page numbers leave no trace in the payload only under the
    member name ``page_no``, so they stay as they are here."""
    copy = json.loads(json.dumps(REPORTS[path]))
    copy["parcel"]["ref"].update(ref)
    return copy


UNITS_PATH = next(p for p in REPORTS if p.endswith("/units.json"))
#: Copies by content (other ids) and by ids (other content); their keys are not remembered, so that a
#: document which shares one with a suppressed copy alone stays.
COPIES = {
    "north_lab/2024-12-01/a by content.json": copied(UNITS_PATH, paper="copy", batch="copy"),
    "north_lab/2024-12-01/b by ids.json": bundle("x", "paper units", "batch units", []),
    "river_hospital/2024-12-02/tree.json": REPORTS["river_hospital/2024-11-05/tree.json"],
    "river_hospital/2024-12-03/tree.json": REPORTS["river_hospital/2024-11-05/tree.json"],
}
REPORTS["north_lab/2024-12-04/after a copy.json"] = bundle(
    "y", "copy", "copy", [panel({}, [(1, "", "3", "Manganese", "")])])
EXPECTED["north_lab/2024-12-04/after a copy.json"] = [
    ("Manganese", "Manganese", 3.0, "ppb", "Unclassified")]
#: Files that can't be read: text or bytes, and the reason in the dead letter.
BROKEN = {
    "sun_lab/2024-12-05/half.json": (json.dumps(COPIES["river_hospital/2024-12-02/tree.json"])[:60], "malformed_json"),
    "sun_lab/2024-12-05/words.json": ("no json at all", "malformed_json"),
    "sun_lab/2024-12-05/number.json": ('{"stamp": NaN}', "malformed_json"),
    "well_lab/2024-12-05/bytes.json": (b'{"stamp": "\xc3\x28"}', "unreadable_file"),
    "nobody/2024-12-05/a.json": ("{}", "unknown_clinic"),
    "nowhere/b.json": ("[]", "unknown_clinic"),
}


def write_config(root: Path) -> str:
    (root / "clinics").mkdir(parents=True)
    for name, cfg in {
        "north_lab": BUNDLE, "hill": OPEN, "river": TREE,
        "well_lab": BUNDLE | {"date_format": "%d-%m-%Y", "discharge_summary": None},
        "sun_lab": BUNDLE,
    }.items():
        (root / "clinics" / f"{name}.json").write_text(json.dumps(cfg, indent=1))
    (root / "test_dictionary.json").write_text(json.dumps({
        "_meta": {"fuzzy_threshold": 90},
        "tests": [{"canonical_name": n, "value_type": v, "unit_canonical": u, "aliases": a}
                  for n, v, u, a in TESTS]}, indent=1))
    keys = ("low", "high", "outlier_low", "outlier_high")
    (root / "reference_ranges.json").write_text(json.dumps(
        {"ranges": {k: dict(zip(keys, v)) for k, v in RANGES.items()}}))
    (root / "unit_conversions.json").write_text(json.dumps({"unit_aliases": {
        k: {"canonical": c, "factor": f} for k, (c, f) in UNITS.items()}}))
    (root / "medicine_mapping.json").write_text(json.dumps({"medicines": [
        {"generic_name": g, "drug_class": c, "brand_names": b} for g, c, b in MEDICINES]}))
    return str(root)


def write_reports(root: Path) -> str:
    texts = {p: json.dumps(d) for p, d in {**REPORTS, **COPIES}.items()} | {p: t for p, (t, _) in BROKEN.items()}
    for name, text in texts.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(root)
