"""Names, units and constants that results depend on and that are not ours to choose."""

# Physical and monetary units.
DAYS_PER_YEAR = 365.25
DAYS_PER_YEAR_FOOD = 365
GJ_TO_EJ = 1e9
MCAL_TO_PCAL = 1e9
PCAL_TO_KCAL = 1e12
KCAL_PER_MCAL = 1e3
THOUSAND = 1e3
DECILE_PERSONS = 1e2  # thousand persons per region -> persons in one tenth of it
DECILE_SHARE = 0.1
USD1990_PER_USD2020 = 0.5575288
KM2_TO_M2 = 1e6

# Correction of one region's income, which the source model reports twenty-fold.
INCOME_CORRECTION = {"South America_Northern": 20.0}

# Years.
REPORT_YEARS = (1990, 2005, 2010, 2015, 2020, 2025, 2030, 2035, 2040, 2045, 2050)
FIRST_REPORT_YEAR = 2020
FINAL_REPORT_YEAR = 2050
CALIBRATION_YEAR = 2020
WATER_BASE_YEAR = 2015
RUNOFF_YEAR_LIMIT = 2055  # exclusive

# Scenario families and the sectors found in scenario names, most specific test first.
SSPS = ("SSP1", "SSP2", "SSP3", "SSP4", "SSP5")
SECTOR_PRECEDENCE = ("sup", "dac", "trn", "bld", "ind", "afolu")
SECTOR_PRECEDENCE_LEGACY = ("sup", "trn", "bld", "ind", "afolu")
SECTOR_PRECEDENCE_LEGACY_LAND = ("dac", "sup", "trn", "bld", "ind", "afolu")
REPORT_SECTORS = ("afolu", "bld", "dac", "ind", "sup", "trn")

# File and database naming.
DB_PREFIX = "database_basexdb_"
PROJECT_SUFFIX = ".dat"

# Gases of the sectoral emissions table.
GASES = (
    "BC", "BC_AWB", "C2F6", "CF4", "CH4", "CH4_AGR", "CH4_AWB", "CO", "CO_AWB", "H2",
    "H2_AWB", "HFC125", "HFC134a", "HFC143a", "HFC152a", "HFC227ea", "HFC23", "HFC236fa",
    "HFC245fa", "HFC32", "HFC365mfc", "HFC43", "N2O", "N2O_AGR", "N2O_AWB", "NH3", "NH3_AGR",
    "NH3_AWB", "NMVOC", "NMVOC_AGR", "NMVOC_AWB", "NOx", "NOx_AGR", "NOx_AWB", "OC", "OC_AWB",
    "PM10", "PM2.5", "SF6", "SO2_1", "SO2_1_AWB", "SO2_2", "SO2_2_AWB", "SO2_3", "SO2_3_AWB",
    "SO2_4", "SO2_4_AWB",
)

# Labels reported as CO2, in the sectoral, the per-resource (older catalog) and the
# per-resource emissions tables.
CO2_LABELS_SECTOR = (
    "afoluCO2", "bldCO2", "indCO2", "indCO2ccs90", "supCO2", "supCO2ccs26", "supCO2ccs82",
    "supCO2ccs88", "supCO2ccs90", "supCO2ccs92", "trnCO2",
)
CO2_LABELS_RESOURCE_OLD = CO2_LABELS_SECTOR + ("CO2_FUG",)
CO2_LABELS_RESOURCE = CO2_LABELS_RESOURCE_OLD + ("dacCO2", "dacCO2ccs95")

# Consumers of the income-group food tables.
FOOD_GROUPS_BY_INCOME = tuple(f"FoodDemand_Group{i}" for i in range(1, 11))

# Food item -> demand sector.
FOOD_ITEMS = {
    "FoodDemand_Staples": ("Corn", "OtherGrain", "Rice", "RootTuber", "Wheat"),
    "FoodDemand_NonStaples": (
        "FiberCrop", "MiscCrop", "Fruits", "Legumes", "NutsSeeds", "OilCrop", "OilPalm", "Soybean",
        "SugarCrop", "Vegetables", "Beef", "Dairy", "Pork", "Poultry", "SheepGoat", "OtherMeat_Fish",
    ),
}

# Macro-region corrections of the mortality tables.
MERGED_REGION = ("RUE", "RUS")
COUNTRY_AS_REGION = ("CHN", "TWN")
SHARES_SCENARIO = "SSP2"

# Land classes that the species-loss factors cover, and grid variables that are not land.
PSL_CLASSES = ("forest", "pasture", "crop_irr", "crop_rfd")
NON_LAND_VARIABLES = ("basin_id", "region_id", "water")
LAND_YEARS = (2020, 2050)
