"""Schemas of the bronze datasets.  Fixed values: the payload fields of the services."""

BRONZE = {
    "trades": "proxyWallet string, side string, price double, size double, conditionId string, timestamp long, transactionHash string, outcome string, name string",
    "markets": "condition_id string, end_date_iso string, game_start_time string, description string, question string, maker_base_fee double, fpmm string, "
    "closed boolean, active boolean, volume double, liquidity double",
    "gamma_markets": "id string, conditionId string, question string, slug string, category string, description string, liquidity string, volume string, "
    "active boolean, closed boolean, startDate string, endDate string, outcomes string, outcomePrices string, clobTokenIds string, volumeNum double, "
    "liquidityNum double, marketGroup long",
    "gamma_events": "marketId string, eventId string, ticker string, slug string, title string, description string, category string, subcategory string, "
    "liquidity double, volume double, active boolean, closed boolean",
    "gamma_categories": "marketId string, categoryId string, label string, parentCategory string, slug string",
    "market_tokens": "condition_id string, price double, token_id string, winner boolean, outcome string",
    "prices": "timestamp long, token_id string, price double",
    "leaderboard": "rank string, proxyWallet string, userName string, xUsername string, verifiedBadge boolean, vol double, pnl double, profileImage string",
}
