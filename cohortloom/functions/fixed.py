"""Fixed values. They must equal published scales, windows and codings for right results; every operator takes them as defaults."""

# Answers that carry no information (lower case, after normalization or as spelled).
MISSING_ANSWERS = [
    "", "skip", "pmi: skip", "pmi_skip", "prefer not to answer", "pmi: prefer not to answer", "pmi_prefernottoanswer",
    "pmi_prefer_not_to_answer", "don't know", "dont know", "pmi_dontknow", "pmi_don'tknow", "pmi_dont_know", "pmi_don't_know",
    "don't know/not sure", "don't know / not sure", "not sure", "i don't know", "i dont know", "unknown", "no answer",
]

# Words ignored when question texts are compared.
STOPWORDS = [
    "a", "about", "all", "also", "an", "and", "answer", "are", "as", "at", "be", "best", "by", "choose", "describes", "did", "disagree",
    "do", "does", "during", "for", "from", "have", "how", "i", "if", "in", "is", "it", "me", "month", "much", "my", "of", "or", "other",
    "past", "please", "response", "say", "select", "that", "the", "their", "this", "to", "was", "were", "what", "when", "whether",
    "which", "with", "would", "you", "your",
]

# Answers that read as a control on a two-answer question.
CONTROL_ANSWERS = ["no", "none", "never", "no problems", "no problem", "no attempt", "usa", "united states", "united states of america"]
CONTROL_PREFIXES = ["no ", "not ", "none ", "never ", "stayed about the same"]

# Kinds of answers to a two-answer question, worst to best, and the normalized spellings of those told by their text.
ANSWER_KINDS = ["control", "plain", "numeric", "other", "problem", "affirmed"]
ANSWER_KIND_PATTERNS = {
    "affirmed": r"\A(yes|true)\z",
    "problem": r"too many|needed treatment|caused problems",
    "other": r"\A(other\z|other |attempt)",
}

# What a coverage audit calls a question, by (has traits, has skipped traits), else by its disposition.
COVERAGE_MADE = {(True, True): "covered_passed_and_qc_skipped", (True, False): "covered_passed", (False, True): "covered_qc_skipped"}
COVERAGE_DISPOSITIONS = {
    None: "missing_metadata_no_encoding_rule", "excluded": "explicitly_excluded", "ordinal_and_binary": "missing_expected_no_manifest_or_skip",
    "binary_only": "missing_expected_no_manifest_or_skip", "nominal_binary": "missing_expected_no_manifest_or_skip",
    "numeric": "missing_expected_no_manifest_or_skip", "else": "metadata_non_gwas_disposition",
}

# Dispositions of a question by its class alone, and the filters a trait may have.
CLASS_DISPOSITIONS = {"descriptive": "excluded_descriptive", "date_text": "excluded_date", "free_text": "excluded_free_text"}
SEX_FILTERS = ["all", "female", "male"]

# Years of schooling and income midpoints (thousands), lowest category first.
EDUCATION_YEARS = [9.0, 9.0, 9.0, 10.0, 13.0, 15.0, 18.0, 20.0]
INCOME_MIDPOINTS = [5.0, 17.5, 30.0, 42.5, 62.5, 87.5, 125.0, 175.0, 250.0]

# Text answers with an ordinal value, and the prefixes tried after them.
TEXT_ORDINAL = {
    "no": 0.0, "yes": 1.0,
    "never": 0.0, "rarely": 1.0, "sometimes": 2.0, "often": 3.0, "very often": 4.0,
    "not at all": 0.0, "some days": 1.0, "every day": 2.0,
    "never in last year": 0.0, "less than monthly": 1.0, "monthly": 2.0, "weekly": 3.0, "daily": 4.0,
    "monthly or less": 1.0, "2 to 4 per month": 2.0, "2 to 3 per week": 3.0, "4 or more per week": 4.0,
    "disagree strongly": 1.0, "disagree a little": 2.0, "neutral; no opinion": 3.0, "agree a little": 4.0, "agree strongly": 5.0,
    "strongly disagree": 1.0, "disagree": 2.0, "neither agree nor disagree": 3.0, "agree": 4.0, "strongly agree": 5.0,
    "poor": 1.0, "fair": 2.0, "good": 3.0, "very good": 4.0, "excellent": 5.0,
    "not at all confident": 1.0, "a little bit confident": 2.0, "somewhat confident": 3.0, "quite a bit confident": 4.0,
    "extremely confident": 5.0,
    "unable to do": 0.0, "with much difficulty": 1.0, "with some difficulty": 2.0, "with a little difficulty": 3.0,
    "without any difficulty": 4.0,
}
TEXT_ORDINAL_PREFIXES = [("never", 0.0), ("less than", 1.0), ("monthly", 2.0), ("weekly", 3.0), ("daily", 4.0)]

# Share of genes held in common with a relative.
RELATION_WEIGHTS = {
    "self": 1.0, "father": 0.5, "mother": 0.5, "parent": 0.5, "sibling": 0.5, "brother": 0.5, "sister": 0.5, "son": 0.5,
    "daughter": 0.5, "child": 0.5, "grandparent": 0.25, "grandmother": 0.25, "grandfather": 0.25, "half-sibling": 0.25,
    "half sibling": 0.25, "none": 0.0,
}

# Plausible physical windows.
WINDOWS = {
    "height_cm": (100.0, 250.0), "systolic": (70.0, 260.0), "diastolic": (40.0, 160.0), "pulse": (30.0, 220.0), "weight_kg": (20.0, 400.0),
    "bmi": (12.0, 80.0), "pulse_pressure": (15.0, 150.0), "mean_pressure": (50.0, 180.0), "height_trait_min": (140.0, None),
}

# Drinks per day band midpoint -> short-scale score; activity weights; months per unit with bounds.
DRINK_SCORES = {1.5: 0.0, 3.5: 1.0, 5.5: 2.0, 8.0: 3.0, 10.0: 4.0}
ACTIVITY_WEIGHTS = {"vigorous": 8.0, "moderate": 4.0, "walking": 3.3}
UNIT_BOUNDS = {"years": (1.0, 99.0), "months": (1.0, 11.0), "weeks": (1.0, 51.0)}
WEEKS_PER_MONTH = 4.345

# Words that mark a sensitive topic.
TOPIC_PATTERNS = [
    ("sexual orientation|gay|lesbian|bisexual|straight|heterosexual|queer|asexual", "sexual_orientation"),
    ("gender identity|transgender|two.?spirit|nonbinary", "gender_identity"),
    ("suicid|kill(ing)? yourself|end your life|self.?harm", "suicidality_self_harm"),
    ("sexual (intercourse|activity|partner|assault|abuse)|forced.*sex|rape", "sexual_behavior_or_trauma"),
    ("abuse|violence|trauma|assault|hit you|hurt you|threatened", "trauma_violence"),
    ("drug use|cannabis|marijuana|cocaine|heroin|opioid|hallucinogen|inhalant|stimulant|illicit", "substance_use"),
    ("alcohol|drink(ing)? .*alcohol|binge", "alcohol"),
    ("menstrua|menopaus|pregnan|ovar|hysterectomy|birth control|abortion|reproductive", "reproductive_menstrual"),
    ("depress|anxiet|bipolar|mania|psychosis|schizophren|panic|ptsd|mental health", "mental_health"),
    ("covid|vaccin|coronavirus|pandemic", "covid_related"),
    ("income|poverty|food (run out|didn't last)|afford|financial", "financial_hardship"),
    ("incarcerat|prison|jail|arrest|police|legal (trouble|problem)", "justice_involvement"),
    ("immigra|citizenship|country.*born|birthplace", "immigration_origin"),
    ("religio|god|spiritual|higher power|faith", "religion"),
    ("disab|deaf|blind|difficulty (walking|dressing|concentrating)", "disability"),
]

# Relatedness cut-offs, filter thresholds and model settings.
KIN_IDENTICAL, KIN_FIRST, KIN_SECOND, KIN_THIRD, KIN_TABLE_MIN, IBS0_CUT = 0.3535, 0.1767, 0.0884, 0.0442, 0.035, 0.0012
UNRELATED_CUT = 0.0441941
MIN_CASES, MIN_CONTROLS, MIN_QUANT_N, MIN_LEVELS = 200, 200, 500, 3
WINSOR_LO, WINSOR_HI, LOGIT_CLIP, REDUNDANT_R, WEAK_LOADING = 0.005, 0.995, 0.001, 0.95, 0.20
SUPPRESS_MAX = 20
MIN_WEAR_DAYS = 10

# Coefficients of the rational approximation to the normal quantile (Wichura, AS 241).
PPF_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4,
         6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3]
PPF_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4,
         3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3]
PPF_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
         1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4]
PPF_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1,
         1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
PPF_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
PPF_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4,
         1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]
