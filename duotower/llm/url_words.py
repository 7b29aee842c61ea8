"""General block list of operator 4: words of hosts and paths that only sell, track or spam, by subject.

The words are common names of such services and subjects, not read off any given pages. A host word fits a whole word of
a host label (between ``.``, ``-`` or the ends), a path word a whole directory or file of the path.
"""

HOST_WORDS = {
    "advert": """ad ads adserver adservers adserve adserving adservice adservices adserv adsrv adsrvr adtech adclick adclicks adimg adimage adimages
        adsystem adnetwork adnetworks adexchange adx adnxs adform adroll adcolony admob admarket admedia adzerk adsense advert adverts advertising
        advertisement advertisements advertiser advertisers banner banners bannerad bannerads clickads popads popad popunder popunders popup popups
        sponsorad sponsorads doubleclick googlesyndication googleadservices googletagservices taboola outbrain criteo rubiconproject pubmatic openx
        propellerads casalemedia smartadserver bidswitch zedo moatads revcontent mgid exoclick trafficjunky juicyads adsterra adblade adtechus
        advertserve servedby yieldmanager yieldmo sharethrough teads indexww sovrn lijit contextweb bidvertiser infolinks""",
    "tracker": """track tracker trackers tracking clicktrack clicktracker clicktracking trk trkr telemetry pixel pixels webbug beacon beacons
        clickstream fingerprinting affiliatetrack affiliates affiliate quantserve scorecardresearch hotjar mixpanel chartbeat clicktale statcounter
        hitcounter webtrends omtrdc demdex bluekai krxd crwdcntrl exelator rlcdn agkn everesttech mathtag tapad adjust appsflyer kochava clickbank
        clickcease clicky mouseflow crazyegg fullstory inspectlet luckyorange""",
    "betting": """casino casinos bet bets betting bettors bookie bookies bookmaker bookmakers sportsbook sportsbooks sportsbet gambling gamble gambler
        gamblers poker pokies roulette blackjack baccarat craps slot slots slotmachine slotmachines jackpot jackpots bingo keno wager wagers wagering
        freespins freebet freebets onlinecasino onlinecasinos livecasino casinobonus pokerstars partypoker sicbo togel judi situs wette wetten
        sportwetten spielbank spielautomaten apuestas apuesta ruleta tragaperras paris-sportifs pronostics""",
    "pharmacy": """pharmacy pharmacies pharma-shop drugstore onlinepharmacy pill pills cheappills viagra cialis levitra kamagra sildenafil tadalafil
        vardenafil xanax valium ambien tramadol oxycontin phentermine modafinil adderall vicodin percocet steroids anabolic dietpills weightloss
        slimming fatburner malenhancement enlargement erectile apotheke farmacia pharmacie""",
    "adult": """adult adults porn porno pornos pornography pornhub pornstar pornstars xxx sex sexy sexcam sexcams sexchat sexshop sextoys nude nudes
        naked erotic erotica erotik erotico erotica-shop escort escorts hentai milf milfs camgirl camgirls camsex livecam livecams webcamsex
        hookup hookups onlyfans xvideos xhamster xnxx redtube youporn bdsm fetish stripper strippers stripclub swingers hardcore nsfw playboy
        brazzers chaturbate livejasmin bongacams stripchat adultfriendfinder sexe sexo sexkontakte hure huren putas""",
    "spam": """spam spammer spammers spamfarm linkfarm linkfarms linkexchange backlink backlinks buylinks seolinks doorway clickbait cashadvance
        payday paydayloan paydayloans quickloan quickloans instantloan easyloan fastcash easymoney quickcash makemoney earnmoney getrich
        workfromhome replica replicas replicawatch replicawatches fakewatches knockoff counterfeit freegift freegifts freeprize giveaways
        sweepstakes ringtones warez keygen keygens serialz crackz nulled torrentz essaywriting essaymill buyessay buyessays buyfollowers
        buylikes astroturf mlm forexsignals cryptodoubler doublebitcoin timeshare timeshares miraclecure""",
}
PATH_WORDS = """ads adserver adservice adclick adframe adiframe advert adverts advertisement advertisements advertorial banner-ads bannerads popunder
    popads sponsored-ads affiliate-link clicktrack clicktracker tracking-pixel trackingpixel pixel.gif beacon.gif webbug casino casinos online-casino
    onlinecasino sportsbook betting-tips free-bets freebets slot-machines online-poker viagra cialis levitra kamagra cheap-pills online-pharmacy porn
    porno xxx sexcam sexcams camgirls escorts hentai payday-loans paydayloans buy-backlinks buylinks linkfarm replica-watches keygen warez""".split()
# Innocent names with a word of the list.
ALLOWED = ("adult-education", "adult-learning", "adult-literacy", "adult-health", "sex-education", "poker-face", "pixel-art", "track-and-field", "slot-cars",
           "weightloss-surgery", "hospital-pharmacy", "school-pharmacy", "sex-chromosome", "anti-spam", "spam-filter", "no-ads", "anti-doping")
