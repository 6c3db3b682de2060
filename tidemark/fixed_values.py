"""Word lists, patterns, lookup rows and limits.

These must equal the published feed conventions for results to be right, so
they are stated plainly in one place and used by name everywhere else.
"""

# --- fixed values: text that means "no value" in a raw feed -----------------
NULL_WORDS = ["", "Not Available", "Not Applicable", "N/A", "NA", "--", "null"]

# --- fixed values: key rules -------------------------------------------------
FACILITY_ID_PATTERN = r"^[0-9A-Z]{6}$"
DATE_PATTERN = "MM/dd/yyyy"
YES_WORDS = ["YES", "Y", "TRUE"]
NO_WORDS = ["NO", "N", "FALSE"]

# --- fixed values: states and their census regions ---------------------------
STATE_REGIONS_HEADER = ["state", "state_name", "census_region", "census_division"]
STATE_REGIONS_TEXT = """\
AL,Alabama,South,East South Central
AK,Alaska,West,Pacific
AZ,Arizona,West,Mountain
AR,Arkansas,South,West South Central
CA,California,West,Pacific
CO,Colorado,West,Mountain
CT,Connecticut,Northeast,New England
DE,Delaware,South,South Atlantic
DC,District of Columbia,South,South Atlantic
FL,Florida,South,South Atlantic
GA,Georgia,South,South Atlantic
HI,Hawaii,West,Pacific
ID,Idaho,West,Mountain
IL,Illinois,Midwest,East North Central
IN,Indiana,Midwest,East North Central
IA,Iowa,Midwest,West North Central
KS,Kansas,Midwest,West North Central
KY,Kentucky,South,East South Central
LA,Louisiana,South,West South Central
ME,Maine,Northeast,New England
MD,Maryland,South,South Atlantic
MA,Massachusetts,Northeast,New England
MI,Michigan,Midwest,East North Central
MN,Minnesota,Midwest,West North Central
MS,Mississippi,South,East South Central
MO,Missouri,Midwest,West North Central
MT,Montana,West,Mountain
NE,Nebraska,Midwest,West North Central
NV,Nevada,West,Mountain
NH,New Hampshire,Northeast,New England
NJ,New Jersey,Northeast,Middle Atlantic
NM,New Mexico,West,Mountain
NY,New York,Northeast,Middle Atlantic
NC,North Carolina,South,South Atlantic
ND,North Dakota,Midwest,West North Central
OH,Ohio,Midwest,East North Central
OK,Oklahoma,South,West South Central
OR,Oregon,West,Pacific
PA,Pennsylvania,Northeast,Middle Atlantic
RI,Rhode Island,Northeast,New England
SC,South Carolina,South,South Atlantic
SD,South Dakota,Midwest,West North Central
TN,Tennessee,South,East South Central
TX,Texas,South,West South Central
UT,Utah,West,Mountain
VT,Vermont,Northeast,New England
VA,Virginia,South,South Atlantic
WA,Washington,West,Pacific
WV,West Virginia,South,South Atlantic
WI,Wisconsin,Midwest,East North Central
WY,Wyoming,West,Mountain
PR,Puerto Rico,Territory,Territory
GU,Guam,Territory,Territory
VI,U.S. Virgin Islands,Territory,Territory
AS,American Samoa,Territory,Territory
MP,Northern Mariana Islands,Territory,Territory
"""

# --- fixed values: measure catalogue -----------------------------------------
MEASURE_CATALOG_HEADER = ["measure_id", "measure_short_name", "domain", "lower_is_better", "unit"]
MEASURE_CATALOG_TEXT = """\
COMP_HIP_KNEE,Hip/knee replacement complications,Complications,true,percent
MORT_30_AMI,Heart attack 30-day mortality,Mortality,true,percent
MORT_30_CABG,CABG 30-day mortality,Mortality,true,percent
MORT_30_COPD,COPD 30-day mortality,Mortality,true,percent
MORT_30_HF,Heart failure 30-day mortality,Mortality,true,percent
MORT_30_PN,Pneumonia 30-day mortality,Mortality,true,percent
MORT_30_STK,Stroke 30-day mortality,Mortality,true,percent
Hybrid_HWM,Hospital-wide mortality (hybrid),Mortality,true,percent
PSI_03_ULCER,Pressure ulcers,Patient safety,true,per 1000 discharges
PSI_04_SURG_COMP,Deaths after treatable surgical complications,Patient safety,true,per 1000 discharges
PSI_06_IAT_PTX,Collapsed lung from procedure,Patient safety,true,per 1000 discharges
PSI_08_POST_HIP,Post-op hip fracture,Patient safety,true,per 1000 discharges
PSI_09_POST_HEM,Post-op bleeding,Patient safety,true,per 1000 discharges
PSI_10_POST_KIDNEY,Post-op kidney injury,Patient safety,true,per 1000 discharges
PSI_11_POST_RESP,Post-op respiratory failure,Patient safety,true,per 1000 discharges
PSI_12_POSTOP_PULMEMB_DVT,Post-op blood clots,Patient safety,true,per 1000 discharges
PSI_13_POST_SEPSIS,Post-op sepsis,Patient safety,true,per 1000 discharges
PSI_14_POSTOP_DEHIS,Wound reopening,Patient safety,true,per 1000 discharges
PSI_15_ACC_LAC,Accidental cuts and tears,Patient safety,true,per 1000 discharges
PSI_90,Patient safety composite (PSI 90),Patient safety,true,ratio
READM_30_AMI,Heart attack 30-day readmission,Readmission,true,percent
READM_30_CABG,CABG 30-day readmission,Readmission,true,percent
READM_30_COPD,COPD 30-day readmission,Readmission,true,percent
READM_30_HF,Heart failure 30-day readmission,Readmission,true,percent
READM_30_HIP_KNEE,Hip/knee 30-day readmission,Readmission,true,percent
READM_30_PN,Pneumonia 30-day readmission,Readmission,true,percent
Hybrid_HWR,Hospital-wide readmission (hybrid),Readmission,true,percent
EDAC_30_AMI,Heart attack excess return days,Return days,true,days per 100 discharges
EDAC_30_HF,Heart failure excess return days,Return days,true,days per 100 discharges
EDAC_30_PN,Pneumonia excess return days,Return days,true,days per 100 discharges
OP_32,Unplanned visits after colonoscopy,Outpatient,true,per 1000 procedures
OP_35_ADM,Admissions during outpatient chemo,Outpatient,true,per 100 patients
OP_35_ED,ED visits during outpatient chemo,Outpatient,true,per 100 patients
OP_36,Unplanned visits after outpatient surgery,Outpatient,true,ratio
"""

# --- fixed values: comparison phrases (matched on lower case) ----------------
COMPARISON_PREFIXES = {
    "better": ["better", "fewer"],
    "worse": ["worse", "more"],
    "no_different": ["no different", "average"],
}
TOO_FEW_PHRASE = "too small"
RATED_CATEGORIES = ["better", "no_different", "worse"]
COMPARISON_CATEGORIES = ["better", "no_different", "worse", "too_few_cases", "not_available"]

# --- fixed values: ownership groups ------------------------------------------
NON_PROFIT_PREFIX = "Voluntary non-profit"
GOVERNMENT_PREFIX = "Government"
GOVERNMENT_OWNERS = ["Veterans Health Administration", "Department of Defense", "Tribal"]
FOR_PROFIT_OWNER = "Proprietary"
PHYSICIAN_OWNER = "Physician"
OWNERSHIP_GROUPS = ["Non-profit", "For-profit", "Government", "Physician-owned", "Other"]

# --- fixed values: survey items pivoted to columns ---------------------------
STAR_ITEMS = {
    "summary_star": "H_STAR_RATING",
    "nurse_communication_star": "H_COMP_1_STAR_RATING",
    "doctor_communication_star": "H_COMP_2_STAR_RATING",
    "staff_responsiveness_star": "H_COMP_3_STAR_RATING",
    "medicine_communication_star": "H_COMP_5_STAR_RATING",
    "discharge_info_star": "H_COMP_6_STAR_RATING",
    "care_transition_star": "H_COMP_7_STAR_RATING",
    "cleanliness_star": "H_CLEAN_STAR_RATING",
    "quietness_star": "H_QUIET_STAR_RATING",
    "recommend_star": "H_RECMND_STAR_RATING",
}
PERCENT_ITEMS = {
    "pct_definitely_recommend": "H_RECMND_DY",
    "pct_rating_9_or_10": "H_HSP_RATING_9_10",
}
STAR_ITEM_SUFFIX = "STAR_RATING"

# --- fixed values: outcome tiers, lowest composite of each tier --------------
TIER_FLOORS = [
    (70, "High performer"),
    (55, "Above average"),
    (45, "Average"),
    (30, "Below average"),
]
LOWEST_TIER = "Low performer"
NO_TIER = "Insufficient data"
OUTCOME_TIERS = [*(name for _, name in TIER_FLOORS), LOWEST_TIER, NO_TIER]
MIN_RATED_MEASURES = 5
DOMAIN_PERCENTILES = {
    "mortality_percentile": "Mortality",
    "readmission_percentile": "Readmission",
    "safety_percentile": "Patient safety",
}

# --- fixed values: check limits ----------------------------------------------
MAX_VOLUME_CHANGE_PCT = 25
MAX_UNRATED_PCT = 60
MAX_UNPARSEABLE = 5
MAX_ORPHAN_PCT = 1
MAX_AGE_DAYS = 200
QUARANTINE_WARN_PCT = 1
QUARANTINE_ERROR_PCT = 5
ORPHAN_ERROR_ROWS = 1000
