def station_row(number, ms, free):
    return {
        "number": number, "name": f"S{number}", "address": "a", "bike_stands": 20,
        "available_bike_stands": free, "last_update": ms, "status": "OPEN",
    }
