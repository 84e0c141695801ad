"""Names, labels, word lists and formats the jobs must agree on."""

from __future__ import annotations

# Columns of the flights landing table, in load order.
FLIGHT_COLUMNS = {
    "Year": "int",
    "FlightDate": "date",
    "Reporting_Airline": "string",
    "DOT_ID_Reporting_Airline": "string",
    "IATA_CODE_Reporting_Airline": "string",
    "Flight_Number_Reporting_Airline": "string",
    "OriginAirportID": "string",
    "OriginCityName": "string",
    "OriginState": "string",
    "DestAirportID": "string",
    "DestCityName": "string",
    "DestState": "string",
    "DepTime": "int",
    "DepDelay": "double",
    "DepDelayMinutes": "double",
    "ArrTime": "int",
    "ArrDelay": "double",
    "ArrDelayMinutes": "double",
    "Distance": "double",
    "CarrierDelay": "double",
    "WeatherDelay": "double",
    "NASDelay": "double",
    "SecurityDelay": "double",
}

# Published yellow-taxi column names and their silver names.
# Columns that keep their name are not listed.
TRIP_TYPES = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}
TRIP_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# Code labels of the trip table.
VENDOR_LABELS = {1: "CMTech", 2: "Verifone"}
PAYMENT_LABELS = {
    1: "credit",
    2: "cash",
    3: "No_Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided_Trip",
}
RATE_LABELS = {
    1: "Standard_rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated_Fare",
    6: "Group_Ride",
}

# The widely published English stop-word list.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve
y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split()

# Words the keyword report drops on top of the list above.
REPORT_STOP_WORDS = [
    "use", "well", "azure", "new", "one", "know", "need", "microsoft", "aws",
    "amazon", "also", "like",
]

# English month names, as written in dates.
MONTHS = """
January February March April May June July August September October November December
""".split()

# Text patterns of personal data, in matching order. They use
# only syntax that Java and RE2 read alike.
ENTITY_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IP": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "CARD": r"\b(?:[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{16})\b",
    "SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "PHONE": r"(?:\+1\s+)?\([0-9]{3}\)\s+[0-9]{3}-[0-9]{4}\b",
    "DATE": r"\b(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|(?:"
    + "|".join(MONTHS)
    + r")\s+[0-9]{1,2},\s+[0-9]{4})\b",
}

# Lowest accepted page confidence, keyword report length,
# forecast length in hours and the normal quantile of its 80 % band.
MIN_CONFIDENCE = 65
KEYWORD_COUNT = 10
FORECAST_HOURS = 6 * 30 * 24
BAND_QUANTILE = 1.2816
