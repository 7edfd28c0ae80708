"""Values of the bank-transaction run: rules, names and the words of the log."""

from __future__ import annotations

from txclean.operators.audit import Note

# Category rules. The first rule with a keyword in the text wins.
CATEGORY_RULES = [
    (["bank", "fees"], "Bank Fees"),
    (["clothing"], "Clothing"),
    (["fit"], "Fitness"),
    (["food", "drink"], "Food & Drink"),
    (["store", "grocer", "supermarket"], "Groceries"),
    (["fuel"], "Fuel"),
    (["corr", "pted"], "Corrupted"),
    (["streaming", "software"], "Subscriptions"),
    (["income"], "Income"),
    (["insur"], "Insurance"),
    (["mobile", "telecom"], "Mobile / Telecom"),
    (["shopping", "retail"], "Online Shopping"),
    (["care"], "Personal Care"),
    (["rent", "mortgages"], "Rent / Mortgages"),
    (["tran", "travel"], "Transport"),
    (["utilities"], "Utilities"),
    (["home"], "Home Furnishing"),
]

# The clean merchant names, each with its known misspellings.
MERCHANT_SPELLINGS = {
    "****": ["****"],
    "Adobe": ["adobe", "Adboe", "Abode", "Adoeb", "adboe", "Aodbe", "Daobe"],
    "Amazon": ["amazon", "Amzon", "Amaon", "Amazn", "Amzan", "amason", "Maazon"],
    "Electricity Co": ["electricity co", "Electricty Co", "ElectricityCo", "electrcity co", "electicity co", "Elcetricity Co", "Leectricity Co"],
    "Gymbox": ["Gmybox", "Gymbx", "Gym Box", "gymbox", "Gynbox", "Gybmox"],
    "Hair Salon": ["Hair Slaon", "Hiar Salon", "Hair Salno", "hair salon", "Hair Salon ", "Hair Aslon", "Hari Salon"],
    "Health Insurance": ["Health Inusrance", "Helath Insurance", "Health Insuranc", "health insurance", "Health Insurnace", "Ehalth Insurance", "Healht Insurance", "Health Nisurance"],
    "IKEA": ["IEKA", "ikea", "IKEA ", "IKAE", "ieka", "Kiea"],
    "LANDLORD LTD": ["landlord ltd", "Landlord Ltd", "Lnadlord Ltd", "landord ltd", "landlordltd", "Alndlord Ltd", "Ladnlord Ltd", "Landlodr Ltd", "Landlrod Ltd"],
    "Netflix": ["Netflxi", "Nteflix", "Netflx", "netflix", "Netlfix", "Entflix", "Neftlix"],
    "Overdraft Fee": ["overdraft fee", "OverdraftFee", "Overdarft Fee", "overdraft  fee", "ovrdraft fee", "Overdraft Efe", "Voerdraft Fee"],
    "PAYROLL LTD": ["payroll ltd", "Payroll Ltd", "payrol ltd", "payro ll ltd", "pyaroll ltd", "Apyroll Ltd", "Paryoll Ltd", "Payorll Ltd", "Payroll Ldt", "Payroll Tld"],
    "Pharmacy": ["pharmacy", "Phamracy", "Pharmcy", "Pharmacy ", "phrarmacy", "Pahrmacy"],
    "Shell Fuel": ["Shell Fuel", "shell fuel", "ShellFuel", "She ll Fuel", "Shello Fuel", "Sehll Fuel", "Shell Feul"],
    "Starbucks": ["starbucks", "Starbuks", "Starbuck", "Strabucks", "Starb ucks", "Satrbucks", "Stabrucks", "Starubcks", "Tsarbucks"],
    "Target": ["Targte", "Target ", "Traget", "tagret", "Tar get", "Atrget"],
    "Tesco": ["Tecso", "Tes co", "Tesco", "Tseco", "Tescco", "Etsco", "Tesoc"],
    "Trainline": ["Trailnine", "Trainlne", "Train line", "trainline", "Trianline", "Traniline"],
    "Uber": ["Ubre", "uber", "Uber ", "Ub er", "Uebr", "Buer"],
    "Verizon": ["verizon", "Verzon", "Verrizon", "Verion", "Verizn", "Evrizon", "Vreizon"],
    "Zara": ["zara", "Zra", "Za ra", "Zarra", "Zar a", "Zaar"],
}

# First instant which is too late for a booking or value date.
DATE_CUTOFF = "2026-01-01 00:00:00"

# Label of negative income.
INCOME, INCOME_REVERSAL = "Income", "Income Reversal"

# The words of the log.
MERCHANT_NOTE = Note("merchant_name", "Merchant Standardisation", "Trim, initcap, dictionary match or fuzzy match")
CATEGORY_NOTE = Note("category", "Category Normalisation", "Keyword-based standardisation rules")
FILL_NOTE = Note("transactionamount", "Missing Value Fix", "Filled NULL using instructedamount")
DUPLICATE_NOTE = Note("duplicate_row", "Duplicate Removal", "Window function (ROW_NUMBER partition) removed duplicate")
DUPLICATE_OLD, DUPLICATE_NEW = "Duplicate identified", "Deleted"
RATE_NOTE = Note("exchangerate", "Logical Constraint Fix", "Enforced rule: exchange rate only allowed when currency != originalcurrency")
DATE_NOTE = Note("BookingDateTime", "Date Validation", "Removed or flagged invalid future dates")
