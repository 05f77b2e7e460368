"""The vocabulary of the two mortgage guides.

These tables are the published rules that results must follow: codes, patterns and
terms, as text and in their natural order.  Operators turn them into expressions.
"""

# Fixed values.  Section-code prefixes of the first guide and their domains; the longest prefix counts.
PREFIX_DOMAINS: list[tuple[str, list[str]]] = [
    ("A1", ["COMPLIANCE.regulatory"]),
    ("A2-1", ["COMPLIANCE.regulatory"]),
    ("A2-2", ["QUALITY_CONTROL.representations"]),
    ("A2-3", ["QUALITY_CONTROL.representations"]),
    ("A2-4", ["COMPLIANCE.data_integrity"]),
    ("A2-5", ["COMPLIANCE.regulatory"]),
    ("A3-1", ["COMPLIANCE.regulatory"]),
    ("A3-2", ["COMPLIANCE.regulatory"]),
    ("A3-3", ["DELIVERY.servicing"]),
    ("A3-4", ["COMPLIANCE.data_integrity", "COMPLIANCE.fraud_prevention"]),
    ("A3-5", ["COMPLIANCE.regulatory"]),
    ("A4", ["COMPLIANCE.regulatory"]),
    ("B1", ["UNDERWRITING.manual_underwriting"]),
    ("B2-1.1", ["PROPERTY.property_eligibility"]),
    ("B2-1.2", ["LOAN.loan_purpose", "LOAN.loan_limits"]),
    ("B2-1.3", ["LOAN.loan_purpose"]),
    ("B2-1.4", ["LOAN.loan_amortization"]),
    ("B2-1.5", ["LOAN.loan_limits", "LOAN.loan_term"]),
    ("B2-2", ["BORROWER.borrower_eligibility"]),
    ("B2-3", ["PROPERTY.property_eligibility", "PROPERTY.property_type"]),
    ("B3-1", ["UNDERWRITING.manual_underwriting"]),
    ("B3-2", ["UNDERWRITING.du_automated"]),
    ("B3-3.1", ["BORROWER.borrower_income"]),
    ("B3-3.2", ["BORROWER.borrower_income"]),
    ("B3-3.3", ["BORROWER.borrower_income"]),
    ("B3-3.4", ["BORROWER.borrower_income"]),
    ("B3-3.5", ["BORROWER.borrower_income"]),
    ("B3-3.6", ["BORROWER.borrower_income"]),
    ("B3-3.7", ["BORROWER.borrower_income"]),
    ("B3-3.8", ["BORROWER.borrower_income"]),
    ("B3-4.1", ["BORROWER.borrower_assets"]),
    ("B3-4.2", ["BORROWER.borrower_assets"]),
    ("B3-4.3", ["BORROWER.borrower_assets"]),
    ("B3-4.4", ["BORROWER.borrower_assets"]),
    ("B3-5", ["BORROWER.borrower_credit"]),
    ("B3-6", ["BORROWER.borrower_liabilities"]),
    ("B4-1", ["PROPERTY.property_valuation"]),
    ("B4-2", ["UNDERWRITING.project_standards"]),
    ("B5-1", ["UNDERWRITING.special_programs", "LOAN.loan_limits"]),
    ("B5-2", ["UNDERWRITING.special_programs", "PROPERTY.property_type"]),
    ("B5-3", ["UNDERWRITING.special_programs"]),
    ("B5-4", ["UNDERWRITING.special_programs"]),
    ("B5-5", ["UNDERWRITING.special_programs"]),
    ("B5-6", ["UNDERWRITING.special_programs"]),
    ("B5-7", ["UNDERWRITING.special_programs"]),
    ("B6", ["LOAN.loan_type"]),
    ("B7-1", ["PROPERTY.property_insurance"]),
    ("B7-2", ["CLOSING.title_requirements"]),
    ("B7-3", ["PROPERTY.property_insurance"]),
    ("B7-4", ["PROPERTY.property_insurance"]),
    ("B8", ["CLOSING.legal_documents"]),
    ("C1", ["DELIVERY.execution_options"]),
    ("C2", ["DELIVERY.loan_delivery"]),
    ("C3", ["DELIVERY.mbs_securitization"]),
    ("D1", ["QUALITY_CONTROL.lender_qc"]),
    ("D2", ["QUALITY_CONTROL.gse_qc"]),
    ("E-1", ["COMPLIANCE.regulatory"]),
    ("E-2", ["COMPLIANCE.regulatory"]),
    ("E-3", ["COMPLIANCE.regulatory"]),
]

# Fixed values.  Chapter ranges of the second guide (both ends included) and their domains.
RANGE_DOMAINS: list[tuple[int, int, list[str]]] = [
    (1101, 1199, ["COMPLIANCE.regulatory"]),
    (1201, 1299, ["COMPLIANCE.regulatory"]),
    (1301, 1399, ["COMPLIANCE.regulatory", "DELIVERY.servicing"]),
    (1401, 1499, ["COMPLIANCE.regulatory"]),
    (1501, 1599, ["COMPLIANCE.regulatory"]),
    (2101, 2199, ["QUALITY_CONTROL.representations"]),
    (2201, 2299, ["BORROWER.borrower_eligibility"]),
    (2301, 2399, ["BORROWER.borrower_eligibility"]),
    (2401, 2499, ["PROPERTY.property_eligibility", "PROPERTY.property_type"]),
    (2501, 2599, ["PROPERTY.property_eligibility"]),
    (3101, 3199, ["BORROWER.borrower_income"]),
    (3201, 3299, ["BORROWER.borrower_assets"]),
    (3301, 3399, ["BORROWER.borrower_credit"]),
    (3401, 3499, ["BORROWER.borrower_liabilities"]),
    (4101, 4199, ["PROPERTY.property_valuation"]),
    (4201, 4299, ["LOAN.loan_purpose", "LOAN.loan_limits"]),
    (4301, 4399, ["UNDERWRITING.special_programs"]),
    (4401, 4499, ["LOAN.loan_amortization"]),
    (4501, 4599, ["UNDERWRITING.project_standards"]),
    (4601, 4699, ["CLOSING.legal_documents"]),
    (4701, 4799, ["CLOSING.title_requirements"]),
    (4801, 4899, ["PROPERTY.property_insurance"]),
    (5101, 5199, ["DELIVERY.loan_delivery"]),
    (5201, 5299, ["DELIVERY.mbs_securitization"]),
    (5301, 5399, ["DELIVERY.execution_options"]),
    (5601, 5699, ["DELIVERY.servicing"]),
    (5701, 5799, ["DELIVERY.servicing"]),
    (6101, 6199, ["QUALITY_CONTROL.lender_qc"]),
    (6201, 6299, ["QUALITY_CONTROL.gse_qc"]),
    (7101, 7199, ["DELIVERY.servicing"]),
    (8101, 8199, ["UNDERWRITING.special_programs"]),
    (9101, 9199, ["COMPLIANCE.regulatory"]),
]

# Fixed values.  Sub-domains by domain.
DOMAINS: list[tuple[str, list[str]]] = [
    ("LOAN", ["loan_purpose", "loan_type", "loan_amortization", "loan_limits", "loan_term"]),
    ("BORROWER", ["borrower_eligibility", "borrower_income", "borrower_assets", "borrower_credit", "borrower_liabilities"]),
    ("PROPERTY", ["property_type", "property_eligibility", "property_valuation", "property_insurance"]),
    ("UNDERWRITING", ["manual_underwriting", "du_automated", "project_standards", "special_programs"]),
    ("CLOSING", ["legal_documents", "title_requirements", "closing_process"]),
    ("DELIVERY", ["execution_options", "loan_delivery", "mbs_securitization", "servicing"]),
    ("QUALITY_CONTROL", ["lender_qc", "gse_qc", "representations"]),
    ("COMPLIANCE", ["regulatory", "fraud_prevention", "data_integrity"]),
]

# Fixed values.  Words that point to a domain where no code does.
KEYWORD_DOMAINS: list[tuple[str, list[str]]] = [
    ("BORROWER.borrower_income", ["income", "employment", "self-employed", "w-2", "tax return"]),
    ("BORROWER.borrower_assets", ["asset", "reserves", "gift funds", "deposit"]),
    ("BORROWER.borrower_credit", ["credit score", "credit report", "fico", "derogatory"]),
    ("BORROWER.borrower_liabilities", ["debt-to-income", "dti", "liability", "monthly obligation"]),
    ("PROPERTY.property_valuation", ["appraisal", "appraised value", "comparable"]),
    ("PROPERTY.property_insurance", ["hazard insurance", "flood insurance", "mortgage insurance"]),
    ("LOAN.loan_purpose", ["purchase transaction", "refinance", "cash-out"]),
    ("UNDERWRITING.du_automated", ["desktop underwriter", "du finding", "automated underwriting"]),
]
FALLBACK_DOMAIN = "COMPLIANCE.regulatory"

# Fixed values.  Industry enumerations: enumeration, value, pattern.
ENUMERATIONS: list[tuple[str, str, str]] = [
    ("LoanPurposeType", "Purchase", r"\bpurchase\s+transaction"),
    ("LoanPurposeType", "NoCashOutRefinance", r"\blimited\s+cash[- ]?out\s+refinanc"),
    ("LoanPurposeType", "CashOutRefinance", r"\bcash[- ]?out\s+refinanc"),
    ("PropertyUsageType", "PrimaryResidence", r"\bprimary\s+residence|principal\s+residence|owner[- ]?occupied"),
    ("PropertyUsageType", "SecondHome", r"\bsecond\s+home"),
    ("PropertyUsageType", "Investor", r"\binvestment\s+propert"),
    ("MortgageType", "Conventional", r"\bconventional\s+mortgage|\bconventional\s+loan"),
    ("MortgageType", "FHA", r"\bFHA[- ]?insured|\bFHA\s+mortgage|\bFHA\s+loan"),
    ("MortgageType", "VA", r"\bVA[- ]?guaranteed|\bVA\s+mortgage|\bVA\s+loan"),
    ("MortgageType", "USDARuralDevelopment", r"\bRD[- ]?guaranteed|\bUSDA|\brural\s+development"),
    ("PropertyType", "Condominium", r"\bcondo(?:minium)?\b"),
    ("PropertyType", "Cooperative", r"\bco[- ]?op(?:erative)?\b"),
    ("PropertyType", "ManufacturedHousing", r"\bmanufactured\s+hous"),
    ("PropertyType", "PUD", r"\bPUD\b|\bplanned\s+unit\s+development"),
    ("PropertyType", "Detached", r"\bdetached\b.*\b(?:single|one)[- ]?(?:family|unit)"),
    ("PropertyType", "TwoToFourUnit", r"\btwo[- ]?\s*to[- ]?\s*four[- ]?unit|\b[234][- ]?unit"),
    ("AmortizationType", "Fixed", r"\bfixed[- ]?rate\s+(?:mortgage|loan)"),
    ("AmortizationType", "AdjustableRate", r"\badjustable[- ]?rate\s+mortgage|\bARM\b"),
    ("LienPriorityType", "FirstLien", r"\bfirst\s+(?:lien|mortgage)"),
    ("LienPriorityType", "SecondLien", r"\bsecond\s+(?:lien|mortgage)|subordinate\s+(?:lien|financing)"),
    ("DocumentationType", "Full", r"\bfull\s+documentation"),
    ("DocumentationType", "Alternative", r"\balternative\s+documentation|\balt[- ]?doc"),
]

# Fixed values.  Glossary terms.
TERMS: list[str] = [
    "LTV",
    "CLTV",
    "HCLTV",
    "DTI",
    "FICO",
    "W-2",
    "1040",
    "Schedule C",
    "Schedule D",
    "Schedule E",
    "Schedule F",
    "K-1",
    "1099",
    "VOE",
    "VOD",
    "VOR",
    "base income",
    "bonus income",
    "commission income",
    "overtime",
    "self-employment income",
    "rental income",
    "alimony",
    "child support",
    "Social Security",
    "pension",
    "retirement income",
    "disability income",
    "trust income",
    "boarder income",
    "capital gains",
    "depository assets",
    "non-depository assets",
    "gift funds",
    "gift of equity",
    "grants",
    "reserves",
    "earnest money",
    "stocks",
    "bonds",
    "mutual funds",
    "retirement accounts",
    "401k",
    "IRA",
    "cash value life insurance",
    "virtual currency",
    "cryptocurrency",
    "credit score",
    "credit report",
    "credit history",
    "derogatory credit",
    "bankruptcy",
    "foreclosure",
    "short sale",
    "deed-in-lieu",
    "charge-off",
    "collection",
    "judgment",
    "tax lien",
    "authorized user",
    "tradeline",
    "nontraditional credit",
    "appraisal",
    "appraised value",
    "comparable sale",
    "sales comparison",
    "desktop appraisal",
    "hybrid appraisal",
    "value acceptance",
    "property inspection",
    "condition rating",
    "quality rating",
    "environmental hazard",
    "flood zone",
    "flood insurance",
    "manufactured housing",
    "modular housing",
    "leasehold",
    "conforming loan",
    "high-balance",
    "jumbo",
    "super conforming",
    "fixed-rate",
    "adjustable-rate",
    "ARM",
    "interest rate",
    "buydown",
    "temporary buydown",
    "permanent buydown",
    "prepayment penalty",
    "balloon payment",
    "mortgage insurance",
    "PMI",
    "MI",
    "LLPA",
    "loan-level price adjustment",
    "purchase",
    "refinance",
    "cash-out refinance",
    "limited cash-out refinance",
    "rate-and-term refinance",
    "HomeReady",
    "HomeStyle",
    "HomeStyle Renovation",
    "High LTV Refinance",
    "Community Seconds",
    "DU",
    "Desktop Underwriter",
    "AUS",
    "HomePath",
    "NACLI",
    "borrower",
    "co-borrower",
    "guarantor",
    "co-signer",
    "seller",
    "servicer",
    "lender",
    "investor",
    "note",
    "security instrument",
    "deed of trust",
    "mortgage",
    "title insurance",
    "hazard insurance",
    "power of attorney",
    "IRS Form 4506-C",
    "URLA",
    "TRID",
    "TILA",
    "RESPA",
    "ATR",
    "QM",
    "qualified mortgage",
    "Dodd-Frank",
    "ECOA",
    "Fair Housing",
    "HMDA",
    "CRA",
    "ability to repay",
    "compensating factors",
    "risk assessment",
    "risk layering",
    "credit risk",
    "collateral risk",
    "front-end ratio",
    "back-end ratio",
    "housing expense ratio",
    "residual income",
    "disposable income",
    "closing disclosure",
    "settlement",
    "escrow",
    "impound",
    "MBS",
    "mortgage-backed securities",
    "TBA",
    "pool",
    "guaranty fee",
    "servicing fee",
    "whole loan",
    "best efforts",
    "mandatory commitment",
]

# Fixed values.  Equivalent parts of the guides: prefix, first and last chapter, topic, relationship.
CROSS_SOURCE: list[tuple[str, int, int, str, str]] = [
    ("B2-1.1", 2301, 2399, "Occupancy type requirements", "equivalent"),
    ("B2-1.2", 4201, 4299, "LTV / CLTV ratio requirements", "equivalent"),
    ("B2-1.3", 4201, 4299, "Loan purpose / transaction type", "related"),
    ("B2-1.4", 4401, 4499, "Loan amortization types (Fixed, ARM)", "equivalent"),
    ("B2-2", 2201, 2399, "Borrower eligibility requirements", "equivalent"),
    ("B2-3", 2401, 2599, "Property eligibility requirements", "equivalent"),
    ("B3-1", 3101, 3199, "Manual underwriting / risk assessment", "related"),
    ("B3-3", 3101, 3199, "Income assessment and documentation", "equivalent"),
    ("B3-4", 3201, 3299, "Asset assessment and verification", "equivalent"),
    ("B3-5", 3301, 3399, "Credit assessment and scoring", "equivalent"),
    ("B3-6", 3401, 3499, "Liability / DTI assessment", "equivalent"),
    ("B4-1", 4101, 4199, "Property valuation / appraisal", "equivalent"),
    ("B4-2", 4501, 4599, "Project standards (Condo, PUD, Co-op)", "equivalent"),
    ("B7", 4801, 4899, "Insurance requirements", "equivalent"),
    ("B8", 4601, 4699, "Legal documents / closing", "equivalent"),
    ("D1", 6101, 6199, "Lender quality control", "equivalent"),
]

# Fixed values.  Signals of content types, in order of precedence; matched against lower-cased text.
CONTENT_SIGNALS: list[tuple[str, list[str]]] = [
    ("definition", [r"\bglossary\b", r"\bacronym", r"\bdefined\s+terms"]),
    ("eligibility_matrix", [r"\beligib\w+\s+matrix", r"\bmaximum\s+LTV", r"\bminimum\s+credit\s+score", r"\beligib\w+\s+requirements?\s+\w+\s+table"]),
    ("procedure", [r"\bstep\s+\d", r"\bprocess\s+for\b", r"\bhow\s+to\b", r"\bprocedure\b", r"\bworkflow\b"]),
    ("reference", [r"\bcontact", r"\bform\s+list", r"\bresource", r"\bexhibit", r"\bsample\s+language"]),
]

# Fixed values.  Entities: type, value, patterns, aliases.
ENTITIES: list[tuple[str, str, list[str], list[str]]] = [
    ("transaction_types", "Purchase", [r"\bpurchase\s+(?:transaction|money\s+mortgage|loan)", r"\bpurchas(?:e|ing)\s+(?:a|the|of)\s+(?:property|home|subject)"], ["purchase", "purchase transaction"]),
    ("transaction_types", "RateTermRefinance", [r"\brate[- ]?(?:and[- ]?)?term\s+refinanc", r"\bno[- ]?cash[- ]?out\s+refinanc"], ["rate-and-term refinance", "rate/term refinance"]),
    ("transaction_types", "CashOutRefinance", [r"\bcash[- ]?out\s+refinanc"], ["cash-out refinance"]),
    ("transaction_types", "LimitedCashOutRefinance", [r"\blimited\s+cash[- ]?out\s+refinanc"], ["limited cash-out refinance"]),
    ("transaction_types", "Refinance", [r"\brefinanc(?:e|ing)\b(?!\s+(?:cash|limited|rate))"], ["refinance"]),
    ("transaction_types", "ConstructionToPermanent", [r"\bconstruction[- ]?to[- ]?perm(?:anent)?"], ["construction-to-permanent"]),
    ("occupancy_types", "PrimaryResidence", [r"\bprimary\s+residence", r"\bprincipal\s+residence", r"\bowner[- ]?occupied"], ["primary residence", "principal residence", "owner-occupied"]),
    ("occupancy_types", "SecondHome", [r"\bsecond\s+home"], ["second home"]),
    ("occupancy_types", "Investment", [r"\binvestment\s+propert", r"\bnon[- ]?owner[- ]?occupied"], ["investment property", "non-owner-occupied"]),
    ("property_types", "SingleFamily", [r"\bsingle[- ]?family\b", r"\b(?:one|1)[- ]?unit\s+(?:dwelling|propert|residen)"], ["single-family", "1-unit"]),
    ("property_types", "Condo", [r"\bcondo(?:minium)?\b"], ["condominium", "condo"]),
    ("property_types", "Coop", [r"\bco[- ]?op(?:erative)?\b"], ["cooperative", "co-op"]),
    ("property_types", "PUD", [r"\bPUD\b", r"\bplanned\s+unit\s+development"], ["PUD", "planned unit development"]),
    ("property_types", "ManufacturedHousing", [r"\bmanufactured\s+hous(?:e|ing)", r"\bmanufactured\s+home"], ["manufactured housing", "manufactured home"]),
    ("property_types", "TwoToFourUnit", [r"\btwo[- ]?\s*to[- ]?\s*four[- ]?unit", r"\b[234][- ]?unit\s+(?:propert|dwelling|residen)"], ["2-4 unit", "two-to-four-unit"]),
    ("property_types", "Leasehold", [r"\bleasehold\b"], ["leasehold"]),
    ("property_types", "MixedUse", [r"\bmixed[- ]?use\b"], ["mixed-use"]),
    ("loan_types", "FixedRate", [r"\bfixed[- ]?rate\s+(?:mortgage|loan)", r"\bFRM\b"], ["fixed-rate mortgage", "FRM"]),
    ("loan_types", "AdjustableRate", [r"\badjustable[- ]?rate\s+mortgage", r"\bARM\b"], ["adjustable-rate mortgage", "ARM"]),
    ("loan_types", "Buydown", [r"\bbuydown\b", r"\bbuy[- ]?down\b"], ["buydown"]),
    ("loan_types", "InterestOnly", [r"\binterest[- ]?only\b"], ["interest-only"]),
    ("loan_types", "HighBalance", [r"\bhigh[- ]?balance\b", r"\bsuper\s+conforming\b"], ["high-balance", "super conforming"]),
    ("lien_positions", "FirstLien", [r"\bfirst\s+(?:lien|mortgage)\b"], ["first lien", "first mortgage"]),
    ("lien_positions", "SecondLien", [r"\bsecond\s+(?:lien|mortgage)\b", r"\bsubordinate\s+(?:lien|financing)\b"], ["second lien", "subordinate lien"]),
    ("program_types", "HomeReady", [r"\bHomeReady\b"], ["HomeReady"]),
    ("program_types", "HomeStyle", [r"\bHomeStyle\b(?!\s+Renovation)"], ["HomeStyle"]),
    ("program_types", "HomeStyleRenovation", [r"\bHomeStyle\s+Renovation\b"], ["HomeStyle Renovation"]),
    ("program_types", "HighLTVRefi", [r"\bhigh[- ]?LTV\s+refi(?:nanc)?", r"\bHigh\s+LTV\s+Refinance\b"], ["High LTV Refinance"]),
    ("program_types", "CommunitySeconds", [r"\bCommunity\s+Seconds\b"], ["Community Seconds"]),
    ("program_types", "HomeOne", [r"\bHome\s*One\b"], ["Home One"]),
    ("program_types", "HomePossible", [r"\bHome\s*Possible\b"], ["Home Possible"]),
    ("program_types", "ChoiceRenovation", [r"\bCHOICE\s+Renovation\b"], ["CHOICE Renovation"]),
    ("program_types", "SuperConforming", [r"\bsuper\s+conforming\b"], ["super conforming"]),
    ("income_sources", "W2Employment", [r"\bW[- ]?2\s+(?:income|employ|wage)", r"\bsalaried\s+(?:employ|income|borrow)"], ["W-2 employment", "salaried employment"]),
    ("income_sources", "SelfEmployment", [r"\bself[- ]?employ"], ["self-employment", "self-employed"]),
    ("income_sources", "Commission", [r"\bcommission\s+income", r"\bcommission[- ]?based"], ["commission income"]),
    ("income_sources", "Bonus", [r"\bbonus\s+income"], ["bonus income"]),
    ("income_sources", "Overtime", [r"\bovertime\s+(?:income|pay|earn)"], ["overtime income"]),
    ("income_sources", "Rental", [r"\brental\s+income", r"\brent\s+(?:received|collected|income)"], ["rental income"]),
    ("income_sources", "SocialSecurity", [r"\bSocial\s+Security\b", r"\bSSA\b", r"\bSSI\b"], ["Social Security", "SSA"]),
    ("income_sources", "Pension", [r"\bpension\s+(?:income|benefit|payment)"], ["pension income"]),
    ("income_sources", "Military", [r"\bmilitary\s+(?:income|pay|allowance)", r"\bBAH\b", r"\bBAS\b"], ["military income", "military pay"]),
    ("income_sources", "BoarderIncome", [r"\bboarder\s+income"], ["boarder income"]),
    ("income_sources", "CapitalGains", [r"\bcapital\s+gain"], ["capital gains"]),
    ("income_sources", "ForeignIncome", [r"\bforeign\s+income", r"\bincome\s+earned\s+(?:in\s+a\s+)?foreign"], ["foreign income"]),
    ("income_sources", "Alimony", [r"\balimony\b", r"\bmaintenance\s+income"], ["alimony"]),
    ("income_sources", "ChildSupport", [r"\bchild\s+support\b"], ["child support"]),
    ("income_sources", "Disability", [r"\bdisability\s+(?:income|benefit|payment)"], ["disability income"]),
    ("income_sources", "TrustIncome", [r"\btrust\s+income"], ["trust income"]),
    ("income_sources", "RetirementDistribution", [r"\bretirement\s+(?:distribution|income|withdraw)", r"\b401[Kk]\s+(?:distribution|withdraw)", r"\bIRA\s+(?:distribution|withdraw)"], ["retirement distribution"]),
    ("income_sources", "InterestDividends", [r"\binterest\s+(?:and\s+)?dividend\s+income", r"\bdividend\s+income"], ["interest and dividend income"]),
    ("income_sources", "NotesReceivable", [r"\bnotes?\s+receivable\s+income"], ["notes receivable income"]),
    ("asset_types", "Depository", [r"\bdepository\s+(?:asset|account)", r"\bchecking\s+account", r"\bsavings\s+account"], ["depository assets", "checking", "savings"]),
    ("asset_types", "NonDepository", [r"\bnon[- ]?depository\s+(?:asset|account)"], ["non-depository assets"]),
    ("asset_types", "Retirement401k", [r"\b401[Kk]\b"], ["401(k)"]),
    ("asset_types", "RetirementIRA", [r"\bIRA\b"], ["IRA"]),
    ("asset_types", "GiftFunds", [r"\bgift\s+fund", r"\bgift\s+(?:of\s+)?money", r"\bgift\s+(?:from|letter)"], ["gift funds"]),
    ("asset_types", "GiftOfEquity", [r"\bgift\s+of\s+equity"], ["gift of equity"]),
    ("asset_types", "GrantFunds", [r"\bgrant\s+fund", r"\bdown\s+payment\s+assistance"], ["grant funds", "down payment assistance"]),
    ("asset_types", "Stocks", [r"\bstock(?:s)?\s+(?:portfolio|holding|account)", r"\bequit(?:y|ies)\s+(?:portfolio|holding)"], ["stocks"]),
    ("asset_types", "Bonds", [r"\bbond(?:s)?\s+(?:portfolio|holding|account)"], ["bonds"]),
    ("asset_types", "MutualFunds", [r"\bmutual\s+fund"], ["mutual funds"]),
    ("asset_types", "CashValueLifeInsurance", [r"\bcash\s+value\s+(?:of\s+)?life\s+insurance"], ["cash value life insurance"]),
    ("asset_types", "Cryptocurrency", [r"\bcryptocurrenc", r"\bvirtual\s+currenc", r"\bdigital\s+(?:asset|currenc)"], ["cryptocurrency", "virtual currency"]),
    ("asset_types", "EarnestMoney", [r"\bearnest\s+money"], ["earnest money"]),
    ("asset_types", "ProceedsFromSale", [r"\bproceeds\s+from\s+(?:the\s+)?sale", r"\bnet\s+(?:sale\s+)?proceeds"], ["proceeds from sale"]),
    ("credit_events", "Bankruptcy", [r"\bbankruptcy\b", r"\bChapter\s+[7](?:\s+bankruptcy)?", r"\bChapter\s+13\b"], ["bankruptcy"]),
    ("credit_events", "Foreclosure", [r"\bforeclosure\b"], ["foreclosure"]),
    ("credit_events", "ShortSale", [r"\bshort\s+sale\b", r"\bpre[- ]?foreclosure\s+sale"], ["short sale"]),
    ("credit_events", "DeedInLieu", [r"\bdeed[- ]?in[- ]?lieu\b"], ["deed-in-lieu"]),
    ("credit_events", "ChargeOff", [r"\bcharge[- ]?off\b"], ["charge-off"]),
    ("credit_events", "Collection", [r"\bcollection\s+account", r"\baccount\s+in\s+collection"], ["collection"]),
    ("credit_events", "Judgment", [r"\bjudgment\b(?!\s+(?:lien|call))"], ["judgment"]),
    ("credit_events", "TaxLien", [r"\btax\s+lien\b"], ["tax lien"]),
    ("credit_events", "LoanModification", [r"\bloan\s+modification\b", r"\bmodified\s+(?:mortgage|loan)\b"], ["loan modification"]),
    ("project_types", "CondoProject", [r"\bcondo(?:minium)?\s+project", r"\bproject\s+(?:review|approval|eligibility).*\bcondo"], ["condo project"]),
    ("project_types", "PUDProject", [r"\bPUD\s+project"], ["PUD project"]),
    ("project_types", "CoopProject", [r"\bco[- ]?op(?:erative)?\s+project"], ["co-op project"]),
    ("project_types", "NewProject", [r"\bnew\s+(?:condo(?:minium)?\s+)?project", r"\bnewly\s+(?:built|constructed)\s+project"], ["new project"]),
    ("project_types", "EstablishedProject", [r"\bestablished\s+(?:condo(?:minium)?\s+)?project"], ["established project"]),
    ("valuation_types", "FullAppraisal", [r"\bfull\s+appraisal", r"\b(?:interior|exterior)\s+(?:and\s+(?:interior|exterior)\s+)?inspection\s+appraisal"], ["full appraisal"]),
    ("valuation_types", "DesktopAppraisal", [r"\bdesktop\s+appraisal"], ["desktop appraisal"]),
    ("valuation_types", "HybridAppraisal", [r"\bhybrid\s+appraisal"], ["hybrid appraisal"]),
    ("valuation_types", "ValueAcceptance", [r"\bvalue\s+acceptance", r"\bappraisal\s+waiver"], ["value acceptance", "appraisal waiver"]),
    ("valuation_types", "PropertyInspection", [r"\bproperty\s+inspection\b(?!\s+waiv)"], ["property inspection"]),
    ("documentation_types", "FullDocumentation", [r"\bfull\s+documentation"], ["full documentation"]),
    ("documentation_types", "AlternativeDocumentation", [r"\balternative\s+documentation", r"\balt[- ]?doc\b"], ["alternative documentation", "alt-doc"]),
    ("documentation_types", "ReducedDocumentation", [r"\breduced\s+documentation"], ["reduced documentation"]),
    ("aus_types", "DesktopUnderwriter", [r"\bDesktop\s+Underwriter\b", r"\bDU\b(?!\s+Refi)"], ["Desktop Underwriter", "DU"]),
    ("aus_types", "LoanProductAdvisor", [r"\bLoan\s+Product\s+Advisor\b", r"\bLPA\b"], ["Loan Product Advisor", "LPA"]),
    ("aus_types", "ManualUnderwriting", [r"\bmanual(?:ly)?\s+underwr"], ["manual underwriting"]),
]

# Fixed values.  Implications: entity, kind, target, description.
IMPLICATIONS: list[tuple[str, str, str, str]] = [
    ("PropertyType.Condo", "REQUIRES", "ProjectReview", "Condominiums require project review per B4-2.2 / Freddie 4501"),
    ("PropertyType.Coop", "REQUIRES", "ProjectReview", "Cooperatives require project review per B4-2.3 / Freddie 4501"),
    ("PropertyType.PUD", "REQUIRES", "ProjectReview", "PUDs require project review per B4-2.1 / Freddie 4501"),
    ("PropertyType.ManufacturedHousing", "REQUIRES", "FoundationInspection", "Manufactured housing requires foundation compliance inspection"),
    ("OccupancyType.Investment", "CONSTRAINS", "LTV <= 85%", "Investment properties have lower maximum LTV (typically 85% purchase, 75% cash-out)"),
    ("OccupancyType.SecondHome", "CONSTRAINS", "LTV <= 90%", "Second homes have lower maximum LTV (typically 90%)"),
    ("TransactionType.CashOutRefinance", "CONSTRAINS", "LTV <= 80%", "Cash-out refinances have lower maximum LTV (typically 80%)"),
    ("IncomeSource.SelfEmployment", "REQUIRES", "TwoYearHistory", "Self-employment income requires 2-year history to demonstrate stability"),
    ("IncomeSource.SelfEmployment", "REQUIRES", "TaxReturnAnalysis", "Self-employment income requires analysis of personal and business tax returns"),
    ("IncomeSource.Commission", "REQUIRES", "TwoYearHistory", "Commission income requires 2-year earning history"),
    ("IncomeSource.Rental", "REQUIRES", "LeaseAgreement", "Rental income requires lease agreement or Schedule E documentation"),
    ("LoanType.AdjustableRate", "REQUIRES", "QualifyingRate", "ARM loans require qualification at the note rate or qualifying rate (whichever is greater)"),
    ("LoanType.Buydown", "REQUIRES", "FullRateQualification", "Buydown loans require borrower qualification at the full note rate"),
    ("LoanType.HighBalance", "REQUIRES", "AdditionalLLPAs", "High-balance loans are subject to additional loan-level price adjustments"),
    ("AUSType.DesktopUnderwriter", "REQUIRES", "DUDocumentationLevel", "DU may issue documentation waivers; specific doc requirements depend on DU findings"),
    ("ProgramType.HomeReady", "REQUIRES", "IncomeLimits", "HomeReady has area median income limits for borrower eligibility"),
    ("ProgramType.HomeReady", "REQUIRES", "HomeownershipEducation", "HomeReady requires completion of homeownership education course"),
    ("ProgramType.HomePossible", "REQUIRES", "IncomeLimits", "Home Possible has area median income limits for borrower eligibility"),
    ("ProgramType.HomePossible", "REQUIRES", "HomeownershipEducation", "Home Possible requires homeownership education for first-time homebuyers"),
    ("CreditEvent.Bankruptcy", "REQUIRES", "WaitingPeriod", "Bankruptcy requires a waiting period (typically 2-4 years depending on chapter)"),
    ("CreditEvent.Foreclosure", "REQUIRES", "WaitingPeriod", "Foreclosure requires a waiting period (typically 7 years, 3 with extenuating circumstances)"),
    ("CreditEvent.ShortSale", "REQUIRES", "WaitingPeriod", "Short sale requires a waiting period (typically 4 years, 2 with extenuating circumstances)"),
    ("CreditEvent.DeedInLieu", "REQUIRES", "WaitingPeriod", "Deed-in-lieu requires a waiting period (typically 4 years, 2 with extenuating circumstances)"),
]

# Fixed values.  Signals of severity, strongest level first.
SEVERITY_SIGNALS: list[tuple[str, list[str]]] = [
    ("must_comply", [r"\bmust\b", r"\bis required\b", r"\bare required\b", r"\bshall\b", r"\bwill not purchase\b", r"\bwill not securitize\b", r"\bineligible\b", r"\bprohibited\b", r"\bnot permitted\b", r"\bnot eligible\b", r"\bmandatory\b", r"\brequired to\b", r"\bmust not\b", r"\bshall not\b", r"\bwill be rejected\b", r"\bwill not accept\b", r"\bmust be\b", r"\bmust have\b", r"\bmust provide\b", r"\bmust obtain\b", r"\bmust verify\b", r"\bmust document\b", r"\bmust include\b"]),
    ("should_comply", [r"\bshould\b", r"\brecommended\b", r"\bexpected to\b", r"\bmay consider\b", r"\bgenerally\b.*\brequire", r"\bnormally\b", r"\btypically\s+(?:required|expected|needed)", r"\bgenerally\s+(?:required|expected|needed)", r"\bshould be\b", r"\bshould not\b", r"\bshould have\b", r"\bshould provide\b"]),
    ("best_practice", [r"\bbest\s+practice\b", r"\bencourage[sd]?\b", r"\bit\s+is\s+good\s+practice\b", r"\badvisable\b", r"\bFannie\s+Mae\s+(?:encourages|recommends)\b", r"\bFreddie\s+Mac\s+(?:encourages|recommends)\b", r"\bprudent\b", r"\bsound\s+(?:practice|business)\b"]),
    ("info_only", [r"\bfor\s+information\b", r"\boverview\b", r"\bintroduction\b", r"\bbackground\b", r"\bdescription\b", r"\bfor\s+reference\b", r"\bnote\s+that\b", r"\bfor\s+additional\s+information\b", r"\bgeneral\s+information\b"]),
]

# Fixed values.  Signals of requirement types; the first of equals counts.
REQUIREMENT_SIGNALS: list[tuple[str, list[str]]] = [
    ("eligibility", [r"\beligib", r"\bqualif", r"\bmaximum\b", r"\bminimum\b", r"\blimit[s]?\b", r"\bnot eligible\b", r"\bineligible\b", r"\bpermissible\b", r"\bacceptable\b", r"\bnot acceptable\b", r"\ballow(?:ed|able)\b", r"\bnot allow(?:ed|able)\b"]),
    ("documentation", [r"\bdocument(?:ation|ed|ing)?\b", r"\bverif(?:y|ied|ication)\b", r"\bevidence\b", r"\bsubstantiat", r"\bprovide\b.*\b(?:copies|records|statements)", r"\bobtain\b", r"\bretain\b.*\b(?:copies|records|documentation)", r"\brecords?\s+(?:must|should|required)"]),
    ("calculation", [r"\bcalculat", r"\bcompute\b", r"\bformula\b", r"\bdetermin[e]?\b.*\b(?:ratio|amount|income|value)", r"\badd\b.*\bsubtract", r"\bdivide\b.*\bby\b", r"\bratio\s+(?:is\s+)?(?:calculated|determined|computed)", r"\bmonthly\s+(?:income|payment)\s+(?:is\s+)?(?:calculated|determined)"]),
]

# Fixed values.  Metrics of numeric limits, and the shapes in which they are stated.
METRICS: list[str] = ["LTV", "CLTV", "HCLTV", "DTI", "credit score", "FICO", "reserves", "debt-to-income", "housing expense", "loan-to-value", "combined loan-to-value"]
CONSTRAINT_SHAPES: list[str] = [
    r"maximum\s+(?:allowable\s+)?{METRIC}\s+(?:ratio\s+)?(?:of\s+|is\s+)?(\d+(?:\.\d+)?)\s*%",
    r"minimum\s+(?:required\s+)?{METRIC}\s+(?:of\s+|is\s+)?(\d+(?:\.\d+)?)",
    r"{METRIC}\s+(?:must|cannot|shall)\s+not\s+exceed\s+(\d+(?:\.\d+)?)\s*%",
    r"(?:at\s+least|minimum\s+of)\s+(\d+)\s+months?\s+(?:of\s+)?reserves",
    r"(\d+(?:\.\d+)?)\s*%\s+(?:maximum\s+)?{METRIC}",
    r"{METRIC}\s+(?:is\s+)?limited\s+to\s+(\d+(?:\.\d+)?)\s*%",
    r"{METRIC}\s+(?:ratio\s+)?(?:of\s+)?(\d+(?:\.\d+)?)\s*%\s+or\s+less",
    r"not\s+to\s+exceed\s+(\d+(?:\.\d+)?)\s*%\s+{METRIC}",
]

# Fixed values.  Words by which a stated limit names its metric, in order of precedence.
METRIC_WORDS: list[tuple[str, str]] = [
    ("hcltv", "HCLTV"), ("cltv", "CLTV"), ("ltv", "LTV"), ("loan-to-value", "LTV"), ("combined loan-to-value", "CLTV"),
    ("dti", "DTI"), ("debt-to-income", "DTI"), ("housing expense", "housing_expense_ratio"),
    ("credit score", "credit_score"), ("fico", "credit_score"), ("reserves", "reserves_months"),
]
AT_MOST_WORDS = ["maximum", "not exceed", "or less", "limited to", "no more than"]
AT_LEAST_WORDS = ["minimum", "at least", "no less than"]

# Fixed values.  Shapes of conditional references; in the last the section comes first.
CONDITIONAL_SHAPES: list[str] = [
    r"(?:if|when|where)\s+(?:the\s+)?(?:property|propert(?:y|ies))\s+(?:is|are)\s+(?:a\s+)?(\w[\w\s-]{2,30}),?\s+(?:see|refer\s+to|review)\s+(?:Section\s+)?([A-Z0-9][\w.-]+)",
    r"(?:for|regarding)\s+(\w[\w\s-]{2,30})\s+(?:properties|loans|transactions),?\s+(?:see|refer\s+to|review)\s+(?:Section\s+)?([A-Z0-9][\w.-]+)",
    r"(?:see|refer\s+to)\s+(?:Section\s+)?([A-Z0-9][\w.-]+)\s+for\s+(?:additional\s+)?(?:requirements?|guidance|information)\s+(?:on|about|regarding|for)\s+(\w[\w\s-]{2,30})",
]
