"""The small labelled table that the URL model is trained from."""

# Fixed values: (url, 1 for unwanted).
LABELLED_URLS = (
    ("http://www.cheap-pills-online.example/buy/viagra", 1), ("http://pills-discount.example/order", 1),
    ("https://pharmacy-cheap-meds.example/sale/pills.html", 1), ("http://cheap-meds.example/no-prescription", 1),
    ("http://casino-royal-win.example/slots", 1), ("https://online-casino.example/bonus?ref=1", 1),
    ("http://win-casino-jackpot.example/play", 1), ("https://poker-casino.example/deposit/bonus", 1),
    ("http://free-bets-today.example/bet", 1), ("https://sports-bets.example/free/odds", 1),
    ("http://best-bets-win.example/betting", 1), ("https://bets-free.example/en/1", 1),
    ("http://spam-link-farm.example/links", 1), ("https://link-farm-seo.example/backlinks", 1),
    ("http://spam-farm-network.example/en/2", 1), ("http://seo-spam.example/farm/links.html", 1),
    ("http://adult-xxx-videos.example/watch", 1), ("https://xxx-adult.example/cams", 1),
    ("http://adult-x-chat.example/live", 1), ("https://sex-adult-x.example/free", 1),
    ("http://ads-click-track.example/pixel?id=4", 1), ("https://track-ads.example/click", 1),
    ("http://m.ad-track-server.example/redirect", 1), ("https://ads-tracker.example/banner", 1),
    ("http://www.ads-banner-track.example/en/44", 1), ("https://blog.ad-track.example/fr/2?page=2", 1),
    ("http://blog.adult-dates-x.example/de/9", 1), ("https://www.free-bets-bonus.example/es/18/", 1),
    ("http://m.casino-win-big.example/en/81.html", 1), ("https://blog.spam-farm-one.example/fr/5#top", 1),
    ("http://win-free-prize.example/claim", 1), ("http://quick-loan-cash.example/apply", 1),
    ("http://replica-watches-cheap.example/shop", 1), ("http://free-download-crack.example/keygen", 1),
    ("https://lottery-win.example/ticket", 1), ("http://weight-loss-pills.example/offer", 1),
    ("https://www.weather.example/en/forecast/12", 0), ("https://news.citypaper.example/fr/article/825?page=2", 0),
    ("http://library.university.example/de/catalogue/17.html", 0), ("https://m.recipes.example/es/soup/4", 0),
    ("https://blog.gardening.example/en/roses/960", 0), ("http://www.museum.example/fr/exhibitions/65.html", 0),
    ("https://docs.software.example/en/manual/install", 0), ("http://thenerth.example/en/676", 0),
    ("https://blog.tionther.example/es/533/", 0), ("http://www.rethand.example/en/453#top", 0),
    ("https://m.eronsh.example/de/612?utm_source=feed", 0), ("http://ingthat.example/fr/414", 0),
    ("https://www.history-society.example/en/archive/1901", 0), ("http://city-council.example/de/meetings", 0),
    ("https://maps.hiking.example/es/trails/31/", 0), ("http://www.school-district.example/en/calendar", 0),
    ("https://physics.institute.example/en/papers/774", 0), ("http://thouor.example/en/25#top", 0),
    ("https://blog.ndering.example/en/671?utm_source=feed", 0), ("https://heanly.example/fr/58", 0),
    ("http://railway-timetable.example/de/station/8", 0), ("https://www.bookshop.example/en/novels/3", 0),
    ("http://thtioner.example/es/148.html", 0), ("https://m.wherend.example/en/770", 0),
    ("https://orchestra.example/de/concerts/12/", 0), ("http://blog.erisnt.example/fr/369#top", 0),
    ("https://www.farmers-market.example/en/opening", 0), ("http://observatory.example/en/sky/5", 0),
    ("https://thehand.example/de/991", 0), ("http://www.translation.example/es/dictionary/77", 0),
)
