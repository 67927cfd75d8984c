"""Writers: result messages, derived points, rule table."""
