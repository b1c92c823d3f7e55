"""Default settings. Every operator takes these as parameters, so another project can pass its own."""

# The vocabulary, names and formats the results depend on.

# Two characters, backslash and n, between the members of a relation field.
RELATION_SEPARATOR = "\\n"

ASU_TYPES = ["Partition", "ASU"]

# File-name endings of tab exports -> schema file.
EXPORT_SCHEMAS = {
    "ASUs.tab": "asu.json",
    "Cuts.tab": "cut.json",
    "sits.tab": "filldeposit.json",
    "ations.tab": "flotation.json",
    "logy.tab": "micromorphology.json",
    "otos.tab": "photo.json",
    "tery.tab": "pottery.json",
    "oins.tab": "potteryjoin.json",
    "dues.tab": "residue.json",
    "Bags.tab": "samplebag.json",
    "inds.tab": "specialfind.json",
    "ures.tab": "structure.json",
    "aces.tab": "surface.json",
}

# File-name endings of stripped comma files -> schema file.
STRIPPED_SCHEMAS = {
    "ASUs.csv": "asu.json",
    "Cuts.csv": "cut.json",
    "sits.csv": "filldeposit.json",
    "ations.csv": "flotation.json",
    "logy.csv": "micromorphology.json",
    "otos.csv": "photo.json",
    "tery.csv": "pottery.json",
    "Bags.csv": "samplebag.json",
    "inds.csv": "specialfind.json",
    "ures.csv": "structure.json",
    "aces.csv": "surface.json",
    "oins.csv": "potteryjoin.json",
    "dues.csv": "residue.json",
    "hell.csv": "shell.json",
    "Bone.csv": "bone.json",
    "n Bones.csv": "humanbone.json",
    "ry2016.csv": "pottery2016.json",
    "ns2016.csv": "flotation.json",
}

# File-name endings of stripped comma files -> site-wide type.
RECORD_TYPES = {
    "ASUs.csv": "ASU",
    "Cuts.csv": "Cut",
    "sits.csv": "FillDeposit",
    "ations.csv": "Flotation",
    "ns2016.csv": "Flotation",
    "ctions.csv": "Section",
    "logy.csv": "Micromorphology",
    "otos.csv": "Photo",
    "lans.csv": "Plan",
    "ry2016.csv": "Pottery",
    "tery.csv": "Pottery",
    "Bags.csv": "SampleBag",
    "inds.csv": "SpecialFind",
    "ures.csv": "Structure",
    "aces.csv": "Surface",
    "ints.csv": "Topography",
    "oins.csv": "Pottery_Join",
    "dues.csv": "Residue",
    "hell.csv": "Shell",
    "Bone.csv": "Bone",
    "n Bones.csv": "Human_Bone",
}

# Ending lengths tried in this order.
ENDING_LENGTHS = [8, 10, 11]

STRIPPED_PREFIX = "Stripped_"

CONTEXT_COLUMNS = [
    "Source", "Type", "Sub-Type", "Identifier", "Title", "Creator",
    "DateEarliest", "DateLatest", "Description", "CoveragePosition",
    "CoverageAltitude", "CoverageArea", "CoverageXYZ", "DateModified",
    "DateTimeZone", "IdentifierUUID", "RelationBelongsTo", "RelationBelongsToUUID",
]

SUMMED_COLUMNS = [
    "PotteryCountBlueSchist", "PotteryCountRedSchist", "PotteryCountBlueAndRedSchist",
    "PotteryCountTalcWare", "PotteryCountPaleVolcanic", "PotteryCountMicaceousSchist",
    "PotteryCountCalciteTemper", "PotteryCountGranitic", "PotteryCountSandy",
    "PotteryCountBiotiteAmphibole", "PotteryCountOtherFabric",
    "PotteryCountBakingPansOrHearths", "PotteryCountCooking",
    "PotteryCountStorageOrPithoidJars", "PotteryCountBraziers", "PotteryCountSauceBoats",
    "PotteryCountBowls", "PotteryCountCups", "PotteryCountDepas", "PotteryCountTankards",
    "PotteryCountConicalNeckedJars", "PotteryCountBasins", "PotteryCountJugs",
    "PotteryCountBeakedJug", "PotteryCountPyxides", "PotteryCountLeggedVessels",
    "PotteryCountOpenShape", "PotteryCountClosedShape", "PotteryCountLids",
    "PotteryCountMoulds", "PotteryCountUnknown", "PotteryCountImpressed",
    "PotteryCountIncised", "PotteryCountRelief", "PotteryCountReliefAndIncised",
    "PotteryCountPainted", "PotteryCountPlain", "PotteryCountWhiteSlip",
    "PotteryCountDarkSlip", "PotteryCountRedSlip", "PotteryCountSlippedAndBurnished",
    "PotteryCountUrfirnis", "PotteryCountScoring", "PotteryCountFine", "PotteryWeightFine",
    "PotteryCountMedium", "PotteryWeightMedium", "PotteryCountCoarse",
    "PotteryWeightCoarse", "PotteryCountBeforeMending", "PotteryWeightBeforeMending",
]

CONTROL_COLUMN = "PotteryCountBeforeMending"

PHASE_SLOTS = [
    "Pre-Phase A", "Phase A", "Phase A/B", "Phase B", "Phase B/C", "Phase C",
    "Phase A-C", "Post-Phase C",
]

# Spelling -> (slot, flag). Any other text goes to the Other slot as it stands.
PHASE_SPELLINGS = {
    "Pre-Phase A": ("Pre-Phase A", "yes"),
    "Phase A": ("Phase A", "yes"),
    "Phase A ?": ("Phase A", "?"),
    "Phase A?": ("Phase A", "?"),
    "Phase A/B": ("Phase A/B", "yes"),
    "Phase A/B ?": ("Phase A/B", "?"),
    "Phase B": ("Phase B", "yes"),
    "Phase B ?": ("Phase B", "?"),
    "Phase B?": ("Phase B", "?"),
    "Phase B/C": ("Phase B/C", "yes"),
    "Phase C": ("Phase C", "yes"),
    "Phase C (?)": ("Phase C", "?"),
    "Phase C?": ("Phase C", "?"),
    "A-C": ("Phase A-C", "yes"),
    "Phase A-C": ("Phase A-C", "yes"),
    "Phase A-C?": ("Phase A-C", "?"),
    "Post-Phase C": ("Post-Phase C", "yes"),
    "Post-Phase C?": ("Post-Phase C", "?"),
}

# The first slot flagged 'yes' names the period.
PERIOD_ORDER = [
    ("Post-Phase C", "Post C"), ("Phase C", "C"), ("Phase B", "B"), ("Phase A", "A"),
    ("Pre-Phase A", "Pre A"), ("Phase A/B", "A/B"), ("Phase B/C", "B/C"),
    ("Phase A-C", "A-C"),
]

# Bag column -> note column of the phase tables.
NOTE_COLUMNS = {
    "PotteryKastri": "Kastri",
    "PotterySherdSizes": "PotterySherdSizes",
    "PotteryWear": "PotteryWear",
    "PotteryBurning": "PotteryBurning",
}

# Find class -> words looked for in the lower-cased title; the first class that hits wins.
FIND_CLASSES = {
    "metallurgical": ["metal"],
    "obsidian": ["obsid"],
    "kouphonisi pebble": ["koufo", "kouph"],
    "stone disc": ["disc"],
    "worked stone": ["worked stone"],
    "spool_whorl": ["spindle", "spool"],
}

COLLECTION_PREFIX = "GEOMETRYCOLLECTION("
POLYGON_PATTERN = r"POLYGON( Z)? ?\(\([^()]*\)\)"
OUTER_RING_PATTERN = r"POLYGON( Z)? ?\(\([^)]*\)"
ANY_POLYGON_PATTERN = r"POLYGON[^()]*+(?:\((?:\([^()]*+\)[\s,]*+)*+\)?)?"
DATE_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[-+]\d{2}:\d{2})?$"
LAYER_CRS = (
    "+proj=tmerc +lat_0=36.8924527603922 +lon_0=25.6468737208999 "
    "+k=1 +x_0=4000 +y_0=4000 +datum=WGS84 +units=m +no_defs"
)
LAYER_COLUMNS = [
    "Source", "Type", "Sub-Type", "Identifier", "Title", "Description", "IdentifierUUID",
]

# Published table -> schema file.
PUBLISHED_TABLES = {
    "all_context": "dbschema/db_allcontext.json",
    "asu": "asu.json",
    "cut": "cut.json",
    "fill_deposit": "filldeposit.json",
    "flotation": "flotation.json",
    "micromorphology": "micromorphology.json",
    "photo": "dbschema/db_photo.json",
    "pottery": "dbschema/db_pottery.json",
    "pottery_join": "potteryjoin.json",
    "residue": "residue.json",
    "sample_bag": "dbschema/db_samplebag.json",
    "special_find": "dbschema/db_specialfind.json",
    "structure": "structure.json",
    "surface": "surface.json",
}

REPORTS = {
    "asu": "excavation_report/er_asu.json",
    "cut": "excavation_report/er_cut.json",
    "fill_deposit": "excavation_report/er_filldeposit.json",
    "sample_bag": "excavation_report/er_samplebag.json",
    "special_find": "excavation_report/er_specialfind.json",
    "structure": "excavation_report/er_structure.json",
    "surface": "excavation_report/er_surface.json",
}

SAMPLE_TITLES = [
    "bone", "fish", "charcoal", "shell", "pottery", "obsidian", "flotation", "seeds",
    "micromorphology", "parasitology", "residue", "radiocarbon", "phytolith",
    "soil chemistry",
]

# End of fixed values.
