"""Fixed values that results depend on."""

# Airline carrier codes, in the order of the one-hot slots.
CARRIERS = (
    "9E", "AA", "AS", "B6", "CO", "DH", "DL", "EA", "EV", "F9", "FL", "HA", "HP", "KH", "ML (1)",
    "MQ", "NW", "OH", "OO", "PA (1)", "PI", "PS", "TW", "TZ", "UA", "US", "VX", "WN", "XE", "YV",
)

# Divisors of the 34 methane columns, linear learner.
METHANE_NORMS = (
    2014.0, 6.0, 31.0, 23.0, 59.0, 59.0, 5.0, 2.4, 5.3, 27.9, 71.0, 1131.7, 31.2, 86.0, 1130.9,
    30.0, 30.0, 30.0, 30.0, 40.0, 30.0, 30.0, 67.7, 258.0, 435.4, 40.5, 6.39, 988.0, 1009.0,
    216.0, 198.0, 121.0, 3.0, 100.0,
)

# Divisors of the 34 methane columns, windowed network.
METHANE_WINDOW_NORMS = (
    2014.0, 12.0, 31.0, 24.0, 60.0, 60.0, 5.0, 5.0, 6.0, 28.0, 100.0, 1200.0, 32.0, 100.0, 1200.0,
    30.0, 30.0, 30.0, 30.0, 40.0, 30.0, 30.0, 70.0, 260.0, 440.0, 41.0, 10.0, 1000.0, 1100.0,
    220.0, 200.0, 150.0, 2.0, 100.0,
)

# Minutes of grace before a departure counts as delayed.
DELAY_GRACE_MINUTES = 15

# Methane warning and alarm levels, in percent.
METHANE_WARNING = 1.0
METHANE_ALARM = 1.5
