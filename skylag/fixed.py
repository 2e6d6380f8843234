"""Names, codes, lists and text formats that results depend on.

Nothing here is logic. Every operator takes these as default arguments, so another
feed, rule list or station list can be passed instead.
"""

# --- fixed values: delay facts -------------------------------------------------
CAUSE_CODES = (
    "A", "C", "D", "E", "G", "I", "M", "N", "O", "P", "R", "S", "T", "V", "W", "NA",
)
TOTAL_DELAY = "DLY_ERT_1"
FLIGHTS = "FLT_ERT_1"
DELAYED_FLIGHTS = "FLT_ERT_1_DLY"
DELAYED_FLIGHTS_15 = "FLT_ERT_1_DLY_15"
CAUSE_GROUPS = {
    "weather_delay": ("W", "D"),
    "industrial_delay": ("I", "N"),
    "atc_delay": ("C", "S", "T", "R"),
}

# --- fixed values: hourly weather ----------------------------------------------
HOURLY_METRICS = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "precipitation", "rain",
    "snowfall", "cloud_cover", "pressure_msl", "surface_pressure", "wind_speed_10m",
    "wind_gusts_10m",
)
# output column: (aggregate, hourly metric)
STATION_DAY_MEASURES = {
    "avg_temperature": ("avg", "temperature_2m"),
    "avg_humidity": ("avg", "relative_humidity_2m"),
    "avg_dew_point": ("avg", "dew_point_2m"),
    "total_precipitation": ("sum", "precipitation"),
    "total_rain": ("sum", "rain"),
    "total_snowfall": ("sum", "snowfall"),
    "avg_cloud_cover": ("avg", "cloud_cover"),
    "avg_pressure_msl": ("avg", "pressure_msl"),
    "avg_surface_pressure": ("avg", "surface_pressure"),
    "avg_wind_speed": ("avg", "wind_speed_10m"),
    "max_wind_gusts": ("max", "wind_gusts_10m"),
    "min_temperature": ("min", "temperature_2m"),
    "max_temperature": ("max", "temperature_2m"),
}
# output column: (aggregate, station-day column)
REGION_DAY_MEASURES = {
    "avg_temperature_europe": ("avg", "avg_temperature"),
    "avg_humidity_europe": ("avg", "avg_humidity"),
    "avg_precipitation_europe": ("avg", "total_precipitation"),
    "avg_rain_europe": ("avg", "total_rain"),
    "avg_snowfall_europe": ("avg", "total_snowfall"),
    "avg_cloud_cover_europe": ("avg", "avg_cloud_cover"),
    "avg_wind_speed_europe": ("avg", "avg_wind_speed"),
    "max_wind_gusts_europe": ("max", "max_wind_gusts"),
}
# feature: (station column, region column)
FALLBACK_FEATURES = {
    "feature_temperature": ("avg_temperature", "avg_temperature_europe"),
    "feature_humidity": ("avg_humidity", "avg_humidity_europe"),
    "feature_precipitation": ("total_precipitation", "avg_precipitation_europe"),
    "feature_rain": ("total_rain", "avg_rain_europe"),
    "feature_snowfall": ("total_snowfall", "avg_snowfall_europe"),
    "feature_cloud_cover": ("avg_cloud_cover", "avg_cloud_cover_europe"),
    "feature_wind_speed": ("avg_wind_speed", "avg_wind_speed_europe"),
    "feature_wind_gusts": ("max_wind_gusts", "max_wind_gusts_europe"),
}
MATCH_STATION = "entity_station"
MATCH_STATION_WITHOUT_WEATHER = "station_missing_weather"
MATCH_REGION = "europe_fallback"
MATCH_NONE = "no_weather"

# --- fixed values: entity text -> weather station, in priority order -------------
STATION_RULES = (
    ("EPWA", ("pansa", "poland")),
    ("EDDF", ("dfs", "germany")),
    ("LFPG", ("dsna", "france")),
    ("EGLL", ("nats", "united kingdom", "uk")),
    ("EHAM", ("lvnl", "netherlands")),
    ("LEMD", ("enaire", "spain")),
    ("LIRF", ("enav", "italy")),
    ("LOWW", ("austro", "austria")),
    ("EBBR", ("skeyes", "belgocontrol", "belgium")),
    ("LSZH", ("skyguide", "switzerland")),
    ("ESSA", ("lfv", "sweden")),
    ("ENGM", ("avinor", "norway")),
    ("EKCH", ("naviair", "denmark")),
    ("EFHK", ("finavia", "fintraffic", "finland")),
    ("LPPT", ("nav portugal", "portugal")),
    ("LROP", ("romatsa", "romania")),
    ("LKPR", ("ans cr", "czech")),
    ("LHBP", ("hungaro", "hungary")),
    ("LGAV", ("hasa", "hasp", "greece")),
    ("EIDW", ("iaa", "ireland")),
    ("LBSF", ("bulatsa", "bulgaria")),
    ("LDZA", ("croatia",)),
    ("LJLA", ("slovenia",)),
    ("LZIB", ("slovak",)),
    ("EYVI", ("oro navigacija", "lithuania")),
    ("EVRA", ("lgs", "latvia")),
    ("EETN", ("eans", "estonia")),
    ("LUKK", ("moldova",)),
    ("UKBB", ("ukraine",)),
    ("LTFM", ("turkey", "dhmi")),
    ("ELLX", ("ana lux", "luxembourg")),
    ("LATI", ("albcontrol", "albania")),
    ("LCLK", ("dcac cyprus", "cyprus")),
    ("UDYZ", ("armats", "armenia")),
    ("LQSA", ("bhansa", "bosnia")),
    ("LYBE", ("smatsa", "serbia", "montenegro")),
    ("LWSK", ("m-nav", "macedonia")),
    ("LMML", ("mats", "malta")),
    ("BKPR", ("ashna", "kosovo")),
)

# --- fixed values: default stations (code, airport, latitude, longitude) ---------
DEFAULT_STATIONS = (
    ("EPWA", "Warsaw Chopin", 52.1657, 20.9671),
    ("EDDF", "Frankfurt", 50.0379, 8.5622),
    ("LFPG", "Paris Charles de Gaulle", 49.0097, 2.5479),
    ("EGLL", "London Heathrow", 51.47, -0.4543),
    ("EHAM", "Amsterdam Schiphol", 52.3105, 4.7683),
    ("LEMD", "Madrid Barajas", 40.4983, -3.5676),
    ("LIRF", "Rome Fiumicino", 41.8003, 12.2389),
    ("LOWW", "Vienna", 48.1103, 16.5697),
    ("EBBR", "Brussels", 50.9014, 4.4844),
    ("LSZH", "Zurich", 47.4647, 8.5492),
    ("ESSA", "Stockholm Arlanda", 59.6519, 17.9186),
    ("ENGM", "Oslo Gardermoen", 60.1939, 11.1004),
    ("EKCH", "Copenhagen", 55.6181, 12.6561),
    ("EFHK", "Helsinki Vantaa", 60.3172, 24.9633),
    ("LPPT", "Lisbon", 38.7742, -9.1342),
    ("LROP", "Bucharest Otopeni", 44.5711, 26.085),
    ("LKPR", "Prague Vaclav Havel", 50.1008, 14.26),
    ("LHBP", "Budapest Ferenc Liszt", 47.4394, 19.2619),
    ("LGAV", "Athens", 37.9364, 23.9445),
    ("EIDW", "Dublin", 53.4213, -6.2701),
    ("LBSF", "Sofia", 42.6967, 23.4114),
    ("LDZA", "Zagreb", 45.7429, 16.0688),
    ("LJLA", "Ljubljana", 46.2237, 14.4576),
    ("LZIB", "Bratislava", 48.1702, 17.2127),
    ("EYVI", "Vilnius", 54.6341, 25.2858),
    ("EVRA", "Riga", 56.9236, 23.9711),
    ("EETN", "Tallinn", 59.4133, 24.8328),
    ("LUKK", "Chisinau", 46.9277, 28.9308),
    ("UKBB", "Kyiv Boryspil", 50.345, 30.8947),
    ("LTFM", "Istanbul", 41.2753, 28.7519),
    ("ELLX", "Luxembourg", 49.6233, 6.2044),
    ("LATI", "Tirana", 41.4147, 19.7206),
    ("LCLK", "Larnaca", 34.8751, 33.6249),
    ("UDYZ", "Yerevan Zvartnots", 40.1473, 44.3959),
    ("LQSA", "Sarajevo", 43.8246, 18.3315),
    ("LYBE", "Belgrade Nikola Tesla", 44.8184, 20.3091),
    ("LWSK", "Skopje", 41.9616, 21.6214),
    ("LMML", "Malta", 35.8575, 14.4775),
    ("BKPR", "Pristina", 42.5728, 21.0358),
)
DEFAULT_METAR_STATIONS = ("KJFK", "KLAX", "EPWA", "EDDF")

# --- fixed values: METAR observations --------------------------------------------
METAR_SOURCE = "aviationweather.gov"
METAR_DATA_SOURCE = "metars"
# event fields taken over unchanged, after station and time
METAR_FIELDS = (
    "raw_text", "latitude", "longitude", "temp_c", "dewpoint_c", "wind_dir_degrees",
    "wind_speed_kt", "wind_gust_kt", "visibility_statute_mi", "altim_in_hg",
    "sea_level_pressure_mb", "flight_category", "metar_type", "elevation_m",
)
METAR_LOOK_BACK = "2 hours"

# --- fixed values: delayed-flight feed -------------------------------------------
FEED_LIST_KEYS = ("response", "data", "flights", "result")
FEED_NESTING_KEY = "response"
FEED_SOURCE = "airlabs"
FEED_THRESHOLD_MINUTES = 60
FEED_TYPE = "departures"
FEED_UNKNOWN_KEY = "unknown-flight"
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
HAS_MORE_PATHS = (
    "$.has_more", "$.request.has_more", "$.response.has_more", "$.response.request.has_more",
)

# --- fixed values: event log, 61 tab-separated columns ---------------------------
EVENT_LOG_FIELDS = (
    "GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "FractionDate", "Actor1Code", "Actor1Name",
    "Actor1CountryCode", "Actor1KnownGroupCode", "Actor1EthnicCode", "Actor1Religion1Code",
    "Actor1Religion2Code", "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code", "Actor2Code",
    "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode", "Actor2EthnicCode",
    "Actor2Religion1Code", "Actor2Religion2Code", "Actor2Type1Code", "Actor2Type2Code",
    "Actor2Type3Code", "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
    "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone", "Actor1Geo_Type",
    "Actor1Geo_FullName", "Actor1Geo_CountryCode", "Actor1Geo_ADM1Code", "Actor1Geo_ADM2Code",
    "Actor1Geo_Lat", "Actor1Geo_Long", "Actor1Geo_FeatureID", "Actor2Geo_Type",
    "Actor2Geo_FullName", "Actor2Geo_CountryCode", "Actor2Geo_ADM1Code", "Actor2Geo_ADM2Code",
    "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID", "ActionGeo_Type",
    "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_ADM1Code", "ActionGeo_ADM2Code",
    "ActionGeo_Lat", "ActionGeo_Long", "ActionGeo_FeatureID", "DATEADDED", "SOURCEURL",
)
EVENT_LOG_SOURCE = "gdelt"
EVENT_LOG_FORMAT = "gdelt_events"
EVENT_LOG_SUFFIX = "export.CSV.zip"

# --- fixed values: airport boards and live positions -----------------------------
BOARD_TOPICS = ("EGLL", "EDDB", "EPWA", "EDDF")
NO_TIME = "Brak"
# south, north, west, east
POSITION_BOX = (49.0, 55.0, 14.0, 24.0)
# output column: feed field
POSITION_FIELDS = {
    "id": "id", "callsign": "callsign", "airline": "airline_icao",
    "aircraft": "aircraft_code", "origin": "origin_airport_iata",
    "destination": "destination_airport_iata", "latitude": "latitude",
    "longitude": "longitude", "altitude_ft": "altitude", "speed_kt": "ground_speed",
    "heading": "heading", "vertical_speed": "vertical_speed", "squawk": "squawk",
}
AIRLINE_POSITION_FIELDS = {
    "callsign": "callsign", "aircraft": "aircraft_code", "origin": "origin_airport_iata",
    "destination": "destination_airport_iata", "altitude_ft": "altitude",
    "speed_kt": "ground_speed", "lat": "latitude", "lon": "longitude",
}

# --- fixed values: model training ------------------------------------------------
LABEL = "delay_per_flight"
DATE = "date"
LEAKING_COLUMNS = (
    "total_delay", "other_delay", "weather_delay", "industrial_delay", "atc_delay",
    "delayed_flights", "delayed_flights_15",
)
TRAIN_SHARE = 0.8
MIN_SPLIT_DATES = 5
SPLIT_SEED = 42
REGRESSION = {"maxIter": 50, "regParam": 0.1, "elasticNetParam": 0.0}
